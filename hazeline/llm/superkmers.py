"""Removal of repeated word sequences by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the smallest hash of the
``m``-word runs inside it, so equal windows have equal minimisers wherever they
stand. Consecutive windows with one minimiser travel together as one packed
string to the minimiser's bucket; packed strings of a task are grouped and
compressed by bucket, so about a third of the text's size is shuffled per
threefold overlap. In a bucket only minimisers that more than one document has
are looked at: their windows are sorted by hash, runs of equal hashes are
compared as strings, and each window's smallest document is known exactly.

A run of words that very many windows have as their minimiser would make one
bucket of all their surroundings. So runs are counted over all texts first, and
hot ones are ranked behind all others: they stay minimisers only of windows that
consist of hot runs alone, which are passages that the combiner below keeps once.

A map-side combiner keeps one packed string per content and task: of equal
strings only the one from the smallest document travels, the others are marked
at once, as all their windows start in a smaller document. So a passage that a
third of all documents share reaches its bucket once per task, and copies of
whole documents cost nothing beyond their first.

Defined cases: NULL texts have no words and texts under ``k`` words no window;
rows with a NULL id neither remove nor lose words; rows with equal ids never
remove each other's words, repeated rows get equal results. Ids are integers.
Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .common import byte_texts, text_key

WINDOW, RUN = 13, 3
#: Bytes of packed strings a map task holds before it sends them on.
HELD = 64 << 20
#: Packed bytes that a bucket is planned for, and how much longer packed strings are than their text.
BUCKET, OVERLAP = 24 << 20, 3
#: Windows of one packed string at most; longer runs are split, their windows keep their bucket.
LONGEST = 1024
MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]

#: A minimiser is hot from this share of a bucket, and never under this share of all runs, so that 2 / LEAST_SHARE bounds the hot ones.
HOT_PART, LEAST_SHARE = 0.25, 1e-5
#: Runs that a task counts at once.
COUNTED = 1 << 20
NONE = np.array([], np.uint64)

#: Types of document, text key, minimiser, first window and string length in a packed block, and its compression.
LAYOUT = (np.int64, np.int32, np.uint32, np.int32, np.int32)
LEVEL = 3

PACKED = "bucket int, doc long, key int, ranges array<int>, blob binary"
MARKS = "doc long, key int, ranges array<int>"


def short_key(text_col: str):
    """32 bits of a text's hash: enough to tell rows of one id apart."""
    return F.shiftright(text_key(F.col(text_col)), 32).cast("int")


def minimisers(words: list[bytes], k: int, m: int, hot: np.ndarray = NONE) -> np.ndarray:
    """The smallest m-word hash of every window of k words; ``hot`` hashes (sorted) count as larger than all others."""
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = len(words) - m + 1
    x = np.zeros(n, np.uint64)
    for i in range(m):
        x = (x ^ (h[i:i + n] * MIX[i % 5])) * MIX[(i + 1) % 5]
        x ^= x >> np.uint64(29)
    x >>= np.uint64(1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, x), len(hot) - 1)
        x |= (hot[at] == x).astype(np.uint64) << np.uint64(63)
    span, least = 1, x
    wanted = k - m + 1
    while span * 2 <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: len(least) - (wanted - span)], least[wanted - span:])
    return least


def packed_runs(words: list[bytes], k: int, m: int, hot: np.ndarray = NONE) -> Iterator[tuple[bytes, int, int, int]]:
    """(string, first window, windows, minimiser) of each run of windows that share a minimiser."""
    values = minimisers(words, k, m, hot)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    starts = [0, *cuts.tolist()]
    ends = [*cuts.tolist(), len(values)]
    if max(map(int.__sub__, ends, starts)) > LONGEST:
        pieces = [(a, min(a + LONGEST, e)) for s, e in zip(starts, ends) for a in range(s, e, LONGEST)]
        starts, ends = map(list, zip(*pieces))
    joined = b" ".join(words)
    at = [0, *accumulate(len(w) + 1 for w in words)]
    # The upper half of a minimiser is enough to deal and group by; windows are compared whole.
    for s, e, v in zip(starts, ends, (values[starts] >> np.uint64(32)).tolist()):
        yield joined[at[s]:at[e + k - 1] - 1], s, e - s, v


def merged(ranges: list[tuple[int, int]]) -> list[int]:
    """Sorted, disjoint half-open ranges as a flat list."""
    out: list[int] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def pack(entries: list[tuple[int, int, int, int, bytes]]) -> bytes:
    """One compressed block of (doc, key, start, minimiser, string) entries."""
    doc, key, start, value, text = zip(*entries)
    parts = [np.array(c, kind).tobytes() for c, kind in zip(([len(entries)], doc, key, value, start, list(map(len, text))), (np.int64, *LAYOUT))]
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([*parts, *text]))


def unpack(blob: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    columns, at = [], 8
    for kind in LAYOUT:
        columns.append(np.frombuffer(raw, kind, n, at))
        at += columns[-1].nbytes
    ends = [at, *(at + np.cumsum(columns[4], dtype=np.int64)).tolist()]
    return columns[:4], [raw[a:b] for a, b in zip(ends, ends[1:])]


class Combiner:
    """Packed strings of one task, one per content, and the ranges that are repeats already."""

    def __init__(self, k: int, buckets: int):
        self.k, self.buckets = k, buckets
        self.clear()

    def clear(self) -> None:
        self.held: dict[bytes, tuple[int, int, int, int]] = {}
        self.more: dict[bytes, list[tuple[int, int, int, int]]] = {}
        self.marks: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.bytes = 0

    def mark(self, doc: int, key: int, start: int, windows: int) -> None:
        ranges = self.marks.setdefault((doc, key), [])
        if ranges and ranges[-1][0] <= start <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], start + windows + self.k - 1))
        else:
            ranges.append((start, start + windows + self.k - 1))
            self.bytes += 100

    def add(self, doc: int, key: int, text: bytes, start: int, windows: int, value: int) -> None:
        first = self.held.get(text)
        if first is None:
            self.held[text] = (doc, key, start, value)
            self.bytes += len(text) + 250
        elif first[0] < doc:
            self.mark(doc, key, start, windows)
        elif first[0] == doc:
            self.more.setdefault(text, []).append((doc, key, start, value))
            self.bytes += 120
        else:  # all places in the document that is not the smallest any more
            for d, q, s, _ in [first, *self.more.pop(text, ())]:
                self.mark(d, q, s, windows)
            self.held[text] = (doc, key, start, value)

    def flush(self) -> pa.RecordBatch:
        grouped: dict[int, list[tuple[int, int, int, int, bytes]]] = {}
        for text, first in self.held.items():
            places = grouped.setdefault(first[3] % self.buckets, [])
            places += [(*place, text) for place in (first, *self.more.get(text, ()))]
        rows = [(b, None, None, None, pack(entries)) for b, entries in grouped.items()]
        rows += [((doc ^ key) % self.buckets, doc, key, merged(ranges), None) for (doc, key), ranges in self.marks.items()]
        self.clear()
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["bucket", "doc", "key", "ranges", "blob"])


def repeats(docs: list[int], keys: list[int], starts: list[int], texts: list[bytes], k: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Word ranges, by (doc, key), of the windows of these packed strings that also start in a smaller document."""
    entry, window, hashes, cuts = [], [], [], []
    for e, text in enumerate(texts):
        at = [0, *accumulate(len(w) + 1 for w in text.split(b" "))]
        n = len(at) - k
        cuts.append(at)
        entry += [e] * n
        window += range(n)
        hashes += [xxhash.xxh64_intdigest(text[a:b - 1]) for a, b in zip(at, at[k:])]
    hashes, entry, window = np.array(hashes, np.uint64), np.array(entry, np.int64), np.array(window, np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, entry, window = hashes[order], entry[order], window[order]
    owner = np.array(docs, np.int64)[entry]
    heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    low, high = np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)
    ends = np.r_[heads[1:], len(hashes)]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def string(e: int, j: int) -> bytes:
        return texts[e][cuts[e][j]:cuts[e][j + k] - 1]

    for a, b in zip(heads[low < high].tolist(), ends[low < high].tolist()):
        group = [(string(e, j), e, j) for e, j in zip(entry[a:b].tolist(), window[a:b].tolist())]
        least: dict[bytes, int] = {}
        for s, e, _ in group:
            least[s] = min(docs[e], least.get(s, docs[e]))
        for s, e, j in group:
            if least[s] < docs[e]:
                at = starts[e] + j
                found.setdefault((docs[e], keys[e]), []).append((at, at + k))
    return found


def hot_minimisers(rows: DataFrame, k: int, m: int, share: float) -> np.ndarray:
    """Sorted hashes that are the minimiser of at least ``share`` of all runs; some from half of that on may be among them.

    Tasks count every run of every text and report hashes from half the share
    of what they have counted: a hash with the full share loses less than half
    of its count that way, so none is missed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def report() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            total = int(n.sum())
            some = n >= max(2, share / 2 * total)
            return pa.RecordBatch.from_arrays([pa.array([*values[some].astype(np.int64).tolist(), None], pa.int64()), pa.array([*n[some].tolist(), total], pa.int64())], names=["value", "n"])

        for batch in batches:
            for text in byte_texts(batch.column(2)):
                words = text.split()
                if len(words) >= k:
                    values = minimisers(words, k, m)
                    held.append(values[np.r_[True, values[1:] != values[:-1]]])
                    if len(held) % 256 == 0 and sum(map(len, held)) >= COUNTED:
                        yield report()
                        held.clear()
        if held:
            yield report()

    counts = stored(rows.mapInArrow(count, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")), "minimisers")
    total = counts.where("value is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most 2 / share hashes reach that.
    hot = counts.where("value is not null").where(F.col("n") >= max(2.0, share / 2 * total)).select("value").collect()
    return np.array(sorted(r.value for r in hot), np.uint64)


def repeated_ranges(docs: DataFrame, k: int = WINDOW, m: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, ranges): word ranges of each document that repeat windows of smaller documents, as flat pairs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), short_key(text_col).alias("key"), F.col(text_col).alias("text")).where("doc is not null")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    # More text makes more buckets, not larger ones.
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size * OVERLAP / BUCKET))

    hot = hot_minimisers(rows, k, m, max(HOT_PART / buckets, LEAST_SHARE))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Combiner(k, buckets)
        for batch in batches:
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2))):
                words = text.split()
                if len(words) < k:
                    continue
                for run, start, windows, value in packed_runs(words, k, m, hot):
                    held.add(doc, key, run, start, windows, value)
                    if held.bytes > HELD:
                        yield held.flush()
        yield held.flush()

    def judge(table: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        columns, texts = [], []
        for row in table.to_pylist():
            if row["blob"] is None:
                pairs = row["ranges"]
                found.setdefault((row["doc"], row["key"]), []).extend(zip(pairs[::2], pairs[1::2]))
            else:
                numbers, strings = unpack(row["blob"])
                columns.append(numbers)
                texts += strings
        if texts:
            doc, key, value, start = (np.concatenate(c) for c in zip(*columns))
            order = np.argsort(value, kind="stable")
            heads = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]])
            shared = np.minimum.reduceat(doc[order], heads) < np.maximum.reduceat(doc[order], heads)
            ends = np.r_[heads[1:], len(order)]
            # Minimisers of several documents; a few at a time, as a window takes more room loose than packed.
            batch: list[int] = []
            groups = [order[a:b] for a, b in zip(heads[shared].tolist(), ends[shared].tolist())]
            for g, rows_of in enumerate(groups):
                batch += rows_of.tolist()
                if len(batch) > 20_000 or g == len(groups) - 1:
                    part = repeats(doc[batch].tolist(), key[batch].tolist(), start[batch].tolist(), [texts[i] for i in batch], k)
                    for who, ranges in part.items():
                        found.setdefault(who, []).extend(ranges)
                    batch = []
        return pa.table({"doc": pa.array([d for d, _ in found], pa.int64()), "key": pa.array([q for _, q in found], pa.int32()),
                         "ranges": pa.array([merged(r) for r in found.values()], pa.list_(pa.int32()))})

    packed = rows.mapInArrow(split, PACKED)
    marks = packed.groupBy("bucket").applyInArrow(judge, MARKS)
    return marks.groupBy("doc", "key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def without_repeats(docs: DataFrame, k: int = WINDOW, m: int = RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) of every row; ``kept`` is the words left, joined by one space."""
    marks = repeated_ranges(docs, k, m, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), short_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    marked = rows.join(marks, (F.col("id") == F.col("doc")) & (F.col("text_key") == F.col("key")), "left").select("id", "ranges", "text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for ranges, text in zip(batch.column(1).to_pylist(), byte_texts(batch.column(2))):
                words = text.split()
                total.append(len(words))
                left, at = [], 0
                pairs = merged(list(zip(ranges[::2], ranges[1::2]))) if ranges else []
                for a, b in zip(pairs[::2], pairs[1::2]):
                    left += words[at:a]
                    at = b
                left += words[at:]
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "kept"])

    return marked.mapInArrow(keep, "id long, n_words long, n_removed long, kept string")
