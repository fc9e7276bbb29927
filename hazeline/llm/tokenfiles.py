"""Token ids of documents in ORC files.

Documents are range-partitioned and sorted by id, encoded, and written as rows
(doc_id, part, at, n_tokens, ids): ``part`` numbers the writing task in id
order and ``at`` counts the ids before the document in its part. ORC stores the
integers run-length encoded in stripes, with minima and maxima per stripe and
row group and Bloom filters on ``doc_id``. Readers take stripes in parallel; a
search by document or by token position skips all stripes and row groups
whose statistics or filters rule it out, and reads no ids but those it returns.
``starts`` adds the parts up, one line per part, so no row moves for it.

Encoding: with a vocabulary that drops white space, every run between ASCII
white space has its ids by itself, and a text is the concatenation of its runs,
which also keeps memory bounded by the text's own size. Arrow cuts the texts of
a slice, numbers their distinct runs, parts these into words and the signs
behind them, and puts the ids together; Python sees each distinct word of a
slice once. Words a worker has not met lately are encoded by the vocabulary's
library: letters that it normalises one by one go straight to its model; other
runs go through the whole library, many in one call. Texts with special
strings, and all texts under other vocabularies, are encoded whole.

Defined cases: a NULL text is empty and holds the end id alone; a NULL id
comes before all others, and is found again as NULL; equal ids follow each
other in the order of their texts, repeated rows included; nothing is
truncated; an empty table gives no rows. Only the id and the text are read, so
other columns may have any name.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import work_dir
from .common import byte_texts, text_key

#: Bytes of a stripe, rows of a row group with its own statistics and Bloom filter, rows between two looks at a stripe's size.
STRIPE_BYTES, GROUP_ROWS, LOOK_ROWS = 16 * 1024 * 1024, 1000, 256
#: Distinct words, and distinct other runs, a worker keeps at hand; as many from before them stay until these are full.
KEPT = 300_000
#: Texts are encoded in slices of about this many bytes.
SLICE = 4 * 1024 * 1024
SPACE = b" \t\n\r\x0b\x0c"
#: Characters that may stand between runs, the first that is a token of its own.
MARKS = "♪★✨→•×«¶§"
#: Characters among which the letters of words are looked for: none of them composes with another.
LETTERS = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
#: ASCII signs that may follow a word, and how many are looked up apart from it.
SIGNS, TAIL = string.punctuation.replace("'", ""), 4


class Encoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        # Tasks are the parallelism; the library's own threads would only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("normalizer") or {}
        pattern = run_pattern(spec)
        self.by_runs = pattern is not None
        self.model = self.library.model
        #: What the model is given for each letter of a word, and a match of a word.
        self.letters = self.letter_table() if self.by_runs else {}
        self.word = re.compile(f"[{''.join(map(chr, self.letters))}]+").fullmatch if self.letters else lambda run: None
        #: Ids of signs behind a word, or None where the vocabulary does not cut them off.
        self.tails: dict[str, bytes | None] = {"": b""}
        self.lowers = "Lowercase" in {s.get("type") for s in [steps, *steps.get("normalizers", [])]}
        self.special = [t["content"].lower().encode() for t in spec.get("added_tokens", [])]
        #: What all of them begin with, if case leaves it alone.
        self.begin = os.path.commonprefix(self.special)
        self.begin = self.begin if self.begin.upper() == self.begin else b""
        #: A character that is one token by itself; no text without it has that token.
        self.mark, self.mark_id = next(((m, i[0]) for m in MARKS if self.by_runs and len(i := self.library.encode(m, add_special_tokens=False).ids) == 1), ("", -1))
        self.words = Lately(self.fresh_words)
        self.odd = Lately(lambda runs: self.encoded_runs(runs))

    def pieces(self, text: str) -> list[str]:
        """What the library gives its model for a text."""
        plain = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def letter_table(self) -> dict[int, str]:
        """What the library makes of each letter; empty if it does not treat a word letter by letter, as one piece."""
        made = {c: self.pieces(c) for c in LETTERS}
        table = {ord(c): found[0] for c, found in made.items() if len(found) == 1}
        every = "".join(map(chr, table))
        turned = [every, every[::-1]]
        one = all(self.pieces(w) == [w.translate(table)] and self.word_ids(w.translate(table)) == self.encoded([w.encode()])[0] for w in turned)
        return table if every and one else {}

    def word_ids(self, piece: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def tail_ids(self, tail: str) -> bytes | None:
        if tail not in self.tails:
            if len(self.tails) > KEPT:
                self.tails = {"": b""}
            apart = self.pieces("aa" + tail) == self.pieces("aa") + self.pieces(tail)
            self.tails[tail] = self.encoded([tail.encode()])[0] if apart else None
        return self.tails[tail]

    def encoded(self, texts: list[bytes]) -> list[bytes]:
        return [np.array(self.library.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    def encoded_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs without special strings: one call for all, the mark between them."""
        texts = [r.decode() for r in runs]
        joined = f" {self.mark} ".join(texts)
        if not self.mark or joined.count(self.mark) >= len(texts):
            return self.encoded(runs)
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        cuts, data = 4 * np.flatnonzero(ids == self.mark_id), ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)])]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; texts should be ``SLICE`` bytes together, longer ones are cut here."""
        if not self.by_runs:
            return self.encoded(texts)
        out: list = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if self.has_special(text):
                out[i] = self.encoded([text])[0]
            elif len(text) > SLICE:
                out[i] = b"".join(self.run_ids([self.form(piece)])[0] for piece in slices(text))
            else:
                plain.append((i, self.form(text)))
        for (i, _), found in zip(plain, self.run_ids([form for _, form in plain])):
            out[i] = found
        return out

    def has_special(self, text: bytes) -> bool:
        """Whether a special string may be in the text, in whatever case."""
        if not self.special or self.begin and self.begin not in text:
            return False
        low = text.lower()
        return any(s in low for s in self.special)

    def form(self, text: bytes) -> bytes:
        """A text in lower case where that cannot matter.

        Where the vocabulary lowers A-Z anyway, it matters only for letters that
        compose with a mark (U+0300 to U+036F) in one case and not in the other.
        """
        return text.lower() if self.lowers and b"\xcc" not in text and b"\xcd" not in text else text

    def run_ids(self, forms: list[bytes]) -> list[bytes]:
        """Ids of texts, run by run; each distinct run is looked up once."""
        if not forms:
            return []
        cut = pc.ascii_split_whitespace(pa.array(forms, pa.binary()).view(pa.string()))
        runs = cut.flatten().dictionary_encode()
        ids = self.distinct_ids(runs.dictionary).take(runs.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]

    def distinct_ids(self, runs: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of distinct runs: of the word and of the signs behind it, or of the whole run."""
        bare = pc.ascii_rtrim(runs, SIGNS).dictionary_encode()
        tails = tail_codes(runs, pc.subtract(pc.binary_length(runs), pc.binary_length(bare.dictionary).take(bare.indices))).dictionary_encode()
        behind = [self.tail_ids(c.to_bytes(TAIL, "little").rstrip(b"\0").decode()) if c >= 0 else None for c in tails.dictionary.to_pylist()]
        words = pa.array(self.words.ids(bytes_of(bare.dictionary)), pa.large_binary()).take(bare.indices)
        ids = pc.binary_join_element_wise(words, pa.array(behind, pa.large_binary()).take(tails.indices), pa.scalar(b"", pa.large_binary()))
        whole = ids.is_null()
        odd = self.odd.ids(bytes_of(runs.filter(whole)))
        return pc.replace_with_mask(ids, whole, pa.array(odd, pa.large_binary()))

    def fresh_words(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of words, None for what is not letters the model takes one by one."""
        texts = b"\n".join(words).decode().split("\n")
        plain = [i for i, text in enumerate(texts) if self.word(text)]
        pieces = "\n".join([texts[i] for i in plain]).translate(self.letters).split("\n")
        out: list = [None] * len(words)
        for i, piece in zip(plain, pieces):
            out[i] = self.word_ids(piece)
        return out


class Lately:
    """Ids of keys met lately, and of those met before them: rare keys go, frequent ones move on."""

    def __init__(self, find: Callable[[list[bytes]], list[bytes | None]]):
        self.find = find
        self.young: dict[bytes, bytes | None] = {}
        self.old: dict[bytes, bytes | None] = {}

    def ids(self, keys: list[bytes]) -> list[bytes | None]:
        """Ids of distinct keys, found in thousands where they are new."""
        young = self.young
        found = [young.get(k, self) for k in keys]
        new = [i for i, ids in enumerate(found) if ids is self]
        if len(young) + len(new) > KEPT:
            self.old, self.young = young, {}
            new = range(len(keys))
        young, old, fresh = self.young, self.old, []
        for i in new:
            ids = found[i] = old.get(keys[i], self)
            if ids is self:
                fresh.append(i)
            else:
                young[keys[i]] = ids
        for lo in range(0, len(fresh), 1000):
            some = fresh[lo:lo + 1000]
            for i, ids in zip(some, self.find([keys[i] for i in some])):
                found[i] = young[keys[i]] = ids
        return found


def bytes_of(column: pa.StringArray) -> list[bytes]:
    return column.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def tail_codes(runs: pa.StringArray, sizes: pa.Int32Array) -> pa.Int64Array:
    """The last ``sizes`` bytes of each run as a little-endian integer, -1 where they are more than ``TAIL``."""
    size, ends = sizes.to_numpy(), runs.offset + np.arange(1, len(runs) + 1)
    ends = np.frombuffer(runs.buffers()[1], np.int32)[ends].astype(np.int64)
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)
    codes = np.where(size > TAIL, -1, 0)
    for k in range(1, TAIL + 1):
        rows = np.flatnonzero((size >= k) & (size <= TAIL))
        codes[rows] |= data[ends[rows] - size[rows] + k - 1].astype(np.int64) << 8 * (k - 1)
    return pa.array(codes, pa.int64())


def kept_encoder(vocabulary: str) -> Encoder:
    """The worker process's encoder, kept for its later tasks; a process that has none makes it."""
    shelf = vars(sys.modules.setdefault("hazeline_worker_shelf", types.ModuleType("hazeline_worker_shelf")))
    if vocabulary not in shelf:
        shelf[vocabulary] = Encoder(vocabulary)
    return shelf[vocabulary]


def run_pattern(spec: dict) -> str | None:
    """The pattern by whose matches the vocabulary cuts texts, if none of them can hold ASCII white space."""
    steps = spec.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    if first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return None
    pattern = first["pattern"].get("Regex")
    space = SPACE.decode()
    probe = "a".join(space) + space + "1" + space + "." + space + "'s"
    return pattern if pattern and not any(set(piece) & set(space) for piece in regex.findall(pattern, probe)) else None


def slices(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``SLICE`` bytes that end at white space."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.find(b" ", at + SLICE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> str:
    """Write the ids of all documents, each followed by ``end_id``, in ascending order of their ids; returns the folder.

    ``vocabulary`` is a file every executor has. Range borders are drawn from
    ids, texts' hashes and row numbers, so neither a repeated id nor a repeated
    row can fill a part of its own.
    """
    path = path or work_dir(docs.sparkSession, "token-files")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = kept_encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for some in bounded(batch):
                ids = [found + end for found in encoder.ids(byte_texts(some.column(1)))]
                sizes = np.array([len(v) // 4 for v in ids], np.int64)
                ends = np.cumsum(sizes)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(ids), part), pa.int32()), pa.array(at + ends - sizes), pa.array(sizes), lists],
                    names=["doc_id", "part", "at", "n_tokens", "ids"])
                at += int(ends[-1])

    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keyed = rows_in.withColumn("key", text_key()).withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("doc_id", "key", "row").sortWithinPartitions("doc_id", "key", "text").select("doc_id", "text")
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    (ordered.mapInArrow(rows, f"doc_id {kind}, part int, at long, n_tokens long, ids array<int>")
     .write.option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", GROUP_ROWS).option("orc.rows.between.memory.checks", LOOK_ROWS)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))
    return path


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``SLICE`` bytes of text, one row at least."""
    sizes = np.cumsum([0 if v is None else v for v in pc.binary_length(batch.column(1)).to_pylist()])
    lo = 0
    while lo < batch.num_rows:
        base = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + SLICE, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the files; a filter on ``doc_id``, ``part`` or ``at`` reaches stripe statistics and Bloom filters."""
    return spark.read.orc(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, part_start, part_tokens): one line per writing task, from two integer columns of the files."""
    sums = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"), "part_tokens")


def starts(rows: DataFrame, path: str) -> DataFrame:
    """Rows of ``read_tokens`` with ``start``, the ids of all documents before them."""
    parts = part_starts(rows.sparkSession, path).select("part", "part_start")
    return rows.join(parts, "part").withColumn("start", F.col("part_start") + F.col("at")).drop("part_start")


def find(spark: SparkSession, path: str, ids: Iterable) -> DataFrame:
    """The rows of given documents, a list the caller holds."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(list(ids)))


def tokens_between(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(doc_id, start, ids) of the part of each document inside token positions ``first`` to ``last``, the end exclusive.

    Only the touched parts are read, and in the outer two only the row groups
    whose ``at`` can reach the range.
    """
    parts = part_starts(spark, path).where((F.col("part_start") < last) & (F.col("part_start") + F.col("part_tokens") > first))
    bounds = parts.agg(F.min_by(F.struct("part", "part_start"), "part").alias("lo"), F.max_by(F.struct("part", "part_start"), "part").alias("hi")).first()
    rows = read_tokens(spark, path)
    if bounds.lo is None:
        rows = rows.where("false")
    else:
        lo, hi = bounds.lo, bounds.hi
        rows = rows.where(F.col("part").between(lo.part, hi.part)
                          & ((F.col("part") < hi.part) | (F.col("at") < last - hi.part_start))
                          & ((F.col("part") > lo.part) | (F.col("at") + F.col("n_tokens") > first - lo.part_start)))
    found = starts(rows, path)
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0)).cast("int")
    stop = F.least(F.lit(last) - F.col("start"), F.col("n_tokens")).cast("int")
    return found.where(stop > skip).select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, stop - skip).alias("ids"))


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, part, at, n_tokens, ids_crc32), the last over the ids as little-endian unsigned 32-bit integers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            found = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(ends), pa.int64()), pa.array(found, pa.int64())],
                                             names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "part", "at", "ids").mapInArrow(summed, f"doc_id {kind}, part int, at long, n_tokens long, ids_crc32 long")
