"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct 64-bit fingerprint emits every value within half the radius of
itself. Two fingerprints within the radius share at least one such value, so a
shuffle on the values brings each linked pair together. At most a ball's worth
of distinct fingerprints (65 at radius 2) can share a value, whatever the data.

Defined cases: a NULL or empty text, or one without words, has fingerprint 0
and is linked like any other; one with fewer words than a shingle is one
shingle; rows with equal texts always share a component; a NULL id never is a
``component_id`` unless its component has no other; an empty table gives an
empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import stored
from .common import components, each_text, free_name, text_key

BITS = 64
#: Shingles whose bits are added at once; bounds the memory of very long texts.
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of one text; a bit is set if more than half of the shingle hashes set it."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the separators of WORD
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        take = min(STEP, n - at)
        hashes = np.fromiter((xxhash.xxh64_intdigest(next(grams), seed) for _ in range(take)), np.uint64, take)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, key, fingerprint) of every row; ``key`` is the text's own hash. No shuffle."""
    id_type = docs.schema[id_col].dataType
    arrow = to_arrow_type(id_type)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, shingle, seed) for t in each_text(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow), batch.column(1), pa.array(values, pa.int64())], names=["id", "key", "fingerprint"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("key", T.LongType()), T.StructField("fingerprint", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).mapInArrow(rows, schema)


def masks(radius: int) -> list[int]:
    """All signed 64-bit masks with at most ``radius`` bits."""
    out = []
    for k in range(radius + 1):
        for bits in combinations(range(BITS), k):
            value = sum(1 << b for b in bits)
            out.append(value - (1 << BITS) if value >> (BITS - 1) else value)
    return out


def ball_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints, that connect all pairs within an even ``radius``.

    ``prints`` holds distinct longs in ``fingerprint``. Values that share a
    variant lie within the radius of one another, so linking each to the
    smallest of them keeps every connection; links are deduplicated and
    verified by their differing bits.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: both sides walk half of it")
    flips = F.array(*[F.lit(m) for m in masks(radius // 2)])
    variants = prints.select("fingerprint", F.explode(flips).alias("flip")).select(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("variant"), "fingerprint")
    from pyspark.sql import Window

    least = F.min("fingerprint").over(Window.partitionBy("variant"))
    pairs = variants.select(least.alias("a"), F.col("fingerprint").alias("b")).where("a < b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """(id, key, fingerprint, component_id) of every row; ``component_id`` is the smallest id reachable over links."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-classes")
    roots = components(ball_links(classes, radius), "simhash")
    labelled = stored(
        classes.join(roots, classes.fingerprint == roots.node, "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")),
        "simhash-labelled")
    named = stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-named")
    members = stored(labelled.join(named, "root").select("fingerprint", "component_id"), "simhash-members")
    return prints.join(members, "fingerprint").select("id", "key", "fingerprint", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """The documents with one row of each component left: the one with the smallest id, then smallest text hash.

    Rows whose component has no id at all count as one group. Repeated rows
    (same id, same text) leave one.
    """
    found = stored(near_duplicates(docs, id_col, text_col, radius, shingle), "simhash-found")
    return first_of_groups(docs, found, id_col, text_col)


def first_of_groups(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group; ``found`` is a stored (id, key, component_id) of every row."""
    # NULL ids come last: a group that has an id is represented by it.
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")
    kept = stored(found.groupBy("component_id").agg(F.min(first).alias("row"), F.count(F.lit(1)).alias("n")).select("row.id", "row.key"), "simhash-kept")
    key, other = free_name(docs, "simhash_key"), free_name(docs, "simhash_id")
    rows = docs.withColumn(key, text_key(F.col(text_col)))
    pick = kept.select(F.col("id").alias(other), F.col("key").alias(f"{key}_kept"))
    out = rows.join(pick, F.col(id_col).eqNullSafe(F.col(other)) & (F.col(key) == F.col(f"{key}_kept")), "left_semi")
    repeated = found.groupBy("id", "key").count().where("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates([id_col, key])
    return out.select(*docs.columns)
