"""How document filters act together: who removes what, in which order, and what it costs.

Five filters judge whole texts. A: fewer than 200 words; B: fewer than half of
the words distinct; C: more than 2 % of the characters are capitals A-Z; D:
any of ``#$%&*|``; E: the text of a document with a smaller id.

E first clears what cannot be a repeat. A counting Bloom filter over all texts
is built in the tasks, counters stopping at two, and the tasks' parts are
merged: a text with a counter of one stands alone, for certain. Only the rest
are possible repeats; their full texts shuffle, combined before they do, and
give the exact smallest id of each text. The filter is cut into segments by
the text's hash, about 4,000 texts each however many there are, so no task
holds more than a segment; segments and facts meet in a join that Spark
broadcasts while the whole filter is small and shuffles, without texts, beyond.

Flags then join by document into a mask, masks are counted per part, and every
order of the filters is answered from at most 32 counts.

Defined cases: a NULL text is empty; an empty text fails A alone, unless it
repeats (B and C compare zero with zero); a NULL source is the part of the empty
string; a NULL id is no smaller id, has none smaller, and has no label; rows
that repeat id and text count each, none being a repeat of the other; of
several labels of one id any 1 counts; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .common import text_key

#: Fixed values of the filters: fewest words, least share of distinct words and greatest of capitals (percent), symbols.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, "[#$%&*|]"
FILTERS = "ABCDE"
#: Counters of a segment, counters per row and probes per text. A segment is 8 KB when merged.
SEGMENT, PER_ROW, PROBES = 1 << 16, 16, 4
#: Hashes a task takes at a time.
PIECE = 1 << 18


def failures(text: Column) -> Column:
    """Bits 1, 2, 4 and 8 for failing A, B, C and D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.char_length(text), text.rlike(SYMBOLS)]
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests[1:], 1)), F.when(tests[0], 1).otherwise(0))


def facts_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One narrow row per document: id, part, mask of A to D, labels, two hashes and a digest of its text."""
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    narrow = rows.select("id", "part", failures(F.col("text")).alias("mask"), text_key().alias("h"), F.unhex(F.sha2("text", 256)).alias("digest"))
    joined = narrow.join(marks, "id", "left").withColumn("probes", F.xxhash64("h"))
    return joined.fillna(0, ["good", "toxic"])


def merged_sketch(facts: DataFrame, segments: int) -> DataFrame:
    """(segment, twice): per segment of the counting filter a bit for each counter that reached two, as 64-bit words."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            h, g = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            held.append((np.mod(h, segments)[:, None] * SEGMENT + np.stack([(g >> (16 * i)) & 0xFFFF for i in range(PROBES)], 1)).ravel())
            size += len(h)
            if size >= PIECE:
                yield from counted(np.concatenate(held))
                held, size = [], 0
        if held:
            yield from counted(np.concatenate(held))

    def counted(codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes, counts = np.unique(codes, return_counts=True)
        segment, at = codes // SEGMENT, (codes % SEGMENT).astype("<u2")
        cuts = np.flatnonzero(np.diff(segment, prepend=-1))
        for some in np.array_split(cuts, max(1, len(cuts) // 5000)):
            if len(some):
                ends = np.append(cuts, len(codes))[np.searchsorted(cuts, some) + 1]
                once = [at[a:b][counts[a:b] == 1].tobytes() for a, b in zip(some, ends)]
                twice = [at[a:b][counts[a:b] > 1].tobytes() for a, b in zip(some, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(segment[some]), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["segment", "once", "twice"])

    def merge(parts: pa.Table) -> pa.Table:
        counters = np.zeros(SEGMENT, np.int64)
        for name, step in (("once", 1), ("twice", 2)):
            for piece in parts.column(name).to_pylist():
                # Positions of a piece are distinct; the counter stops at two.
                at = np.frombuffer(piece, "<u2")
                counters[at] = np.minimum(counters[at] + step, 2)
        words = np.packbits(counters == 2, bitorder="little").view("<i8")
        return pa.table({"segment": parts.column("segment").slice(0, 1), "twice": pa.array([words.tolist()], pa.list_(pa.int64()))})

    parts = facts.select("h", "probes").mapInArrow(partial, "segment long, once binary, twice binary")
    return parts.groupBy("segment").applyInArrow(merge, "segment long, twice array<long>")


def possible_repeats(facts: DataFrame) -> DataFrame:
    """Facts of the rows whose text the merged filter cannot clear; every text of two rows or more is among them."""
    segments = max(1, math.ceil(facts.count() * PER_ROW / SEGMENT))
    sketch = stored(merged_sketch(facts, segments), "filters-sketch")

    def full(i: int) -> Column:
        at = F.shiftright("probes", 16 * i).bitwiseAND(F.lit(0xFFFF))
        return F.getbit(F.get("twice", F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

    rows = facts.withColumn("segment", F.pmod("h", F.lit(segments).cast("long")))
    met = rows.join(sketch.withColumnRenamed("segment", "s"), F.col("segment") == F.col("s"))
    for i in range(PROBES):
        met = met.where(full(i))
    return met.select(facts.columns)


def first_copies(docs: DataFrame, possible: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, first_id) of every text that documents of different ids share."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", text_key())
    texts = rows.join(possible.select("h").distinct(), "h", "left_semi")
    shared = texts.groupBy("text").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id")
    return shared.select(F.unhex(F.sha2("text", 256)).alias("digest"), "first_id")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters, bit i for the i-th letter of ``FILTERS``."""
    facts = stored(facts_of(docs, labels, id_col, text_col, source_col), "filters-facts")
    possible = stored(possible_repeats(facts), "filters-possible")
    copies = possible.join(first_copies(docs, possible, id_col, text_col), "digest").where(F.col("id") > F.col("first_id"))

    def counted(rows: DataFrame, sign: int) -> DataFrame:
        return rows.groupBy("part", "mask").agg(*(F.sum(F.lit(sign) * F.col(c)).alias(c) for c in ("n", "good", "toxic")))

    def counts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    repeated = stored(counts(copies), "filters-repeated")
    moved = repeated.withColumn("mask", F.col("mask").bitwiseOR(F.lit(16)))
    return counted(counts(facts).unionByName(moved).unionByName(counted(repeated, -1)), 1).where("n > 0")


def orders() -> Column:
    """All orders of the filters, step by step: (filter_order, step, bit of the step's filter, bits of those before)."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")))
            before |= bit
    return F.array(*rows)


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` is what the step's filter removes over all 120 orders: a
    document with c failed filters goes by each of them in 120 / c orders.
    """
    found = mask_counts(docs, labels, id_col, text_col, source_col)
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = parts.withColumn("o", F.explode(orders())).select("part", "masks", "o.*")

    def total(test, value="n") -> Column:
        return F.aggregate(F.filter("masks", test), F.lit(0).cast("long"), lambda a, m: a + (m[value] if isinstance(value, str) else value(m)))

    def fails(m) -> Column:
        return m["mask"].bitwiseAND(F.col("bit")) != 0

    def passed(m) -> Column:
        return m["mask"].bitwiseAND(F.col("before")) == 0

    def here(m) -> Column:
        return fails(m) & passed(m)

    share = F.lit(math.factorial(len(FILTERS)))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: m["mask"].bitwiseAND(F.col("before").bitwiseOR(F.col("bit"))) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: fails(m) & ~passed(m)).alias("redundant"),
        total(lambda m: m["mask"] == F.col("bit")).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"),
        total(fails, lambda m: (m["n"] * (share / F.bit_count(m["mask"])).cast("long"))).alias("shapley"))
