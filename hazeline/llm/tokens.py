"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a piece form a linked list; the adjacent pair of lowest rank is
popped from a heap and merged, pairs that a merge has changed are skipped when
they come up, and its new neighbours are pushed. A piece has as many tokens as
initial symbols less merges; no token is ever named. Every text is split by the
vocabulary's own rules, read from its file: special strings count as one token
each, the rest is normalised, cut into pieces, and taken byte by byte.

Defined cases: NULL is an empty text with no tokens; repeated rows give
repeated results; nothing is truncated or padded. Only the id and the text are
read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import byte_texts

#: Pieces whose counts a task keeps; beyond that it starts anew.
KEPT = 500_000


#: Letters and digits of Unicode 17, by code points: the vocabulary's library cuts by Unicode 16 and takes them for other characters.
YOUNG = "".join("-".join(f"\\U{int(c, 16):08x}" for c in r.split("-")) for r in (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 "
    "1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F ").split())
#: Capitals that the library lowers and Python does not yet.
CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
            **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
#: The first of all these.
FIRST_YOUNG = "\u0558"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself where it prints, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Merges:
    """The merge ranks of a vocabulary file, and its rules for cutting texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [spec["normalizer"], *spec["normalizer"].get("normalizers", [])]
        if model["type"] != "BPE" or model["unk_token"] or model["dropout"]:
            raise ValueError("a byte-pair vocabulary without unknown token and dropout is needed")
        kinds = {s["type"] for s in steps}
        if kinds - {"Sequence", "NFC", "Replace", "Lowercase"}:
            raise ValueError(f"normalizers {sorted(kinds)} are not all known")
        self.compose, self.lower = "NFC" in kinds, "Lowercase" in kinds
        cuts = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        # White space is spelled out, as libraries differ about control characters.
        space = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.cut = regex.compile(cuts[0].replace(r"\s", space)) if cuts else None
        # The same cuts with Unicode 16; sets without sets are searched faster, and few texts need these.
        older = (cuts[0] if cuts else "").replace(r"\s", space).replace(r"\p{L}", rf"[\p{{L}}--[{YOUNG}]]").replace(r"\p{N}", rf"[\p{{N}}--[{YOUNG}]]")
        self.cut_older = regex.compile("(?V1)" + older) if cuts else None
        self.young = regex.compile(f"[{YOUNG}{''.join(map(chr, CAPITALS))}]")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        letters, end = byte_letters(), model["end_of_word_suffix"] or ""
        number: dict[str, int] = {}
        for word in [*letters, *(c + end for c in letters)]:
            number.setdefault(word, len(number))
        self.first = [number[c] for c in letters]
        self.last = [number[c + end] for c in letters]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            joined = number.setdefault(a + b, len(number))
            self.ranks.setdefault((number[a], number[b]), (rank, joined))
        self.counts: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Tokens of one piece: initial symbols less merges."""
        data = piece.encode()
        n = len(data)
        symbols = [self.first[b] for b in data[:-1]] + [self.last[data[-1]]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, heap = self.ranks, []
        for i in range(n - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, joined = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            merges += 1
            symbols[i], symbols[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks.get((joined, symbols[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, joined, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = ranks.get((symbols[h], joined))
                if found:
                    heapq.heappush(heap, (found[0], h, symbols[h], joined, found[1]))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if self.compose and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        cut = self.cut
        if not text.isascii() and max(text) >= FIRST_YOUNG and self.young.search(text):
            cut = self.cut_older
            text = text.translate(CAPITALS) if self.lower else text
        if self.lower:
            # One letter at a time: no rule about a word's last sigma.
            text = text.replace("Σ", "σ").lower()
        total, counts = 0, self.counts
        for piece in cut.findall(text) if cut else [text]:
            n = counts.get(piece)
            if n is None:
                if len(counts) >= KEPT:
                    counts.clear()
                n = counts[piece] = self.merged(piece)
            total += n
        return total

    def count(self, text: str) -> int:
        if not self.special or "<" not in text and not self.special.search(text):
            return self.plain(text)
        total = at = 0
        for m in self.special.finditer(text):
            total += self.plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self.plain(text[at:])


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row. ``vocabulary`` is a file every executor has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(vocabulary)
        for batch in batches:
            texts = byte_texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array([merges.count(t.decode()) for t in texts], pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows_in.mapInArrow(rows, f"id {rows_in.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
