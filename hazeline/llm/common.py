"""Helpers shared by the text operators: row keys, words, columns of our own and connected components."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored

#: Runs of characters outside this set are words: space and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of a batch that are Python objects at a time.
ROWS = 128


def text_key(text: Column | str = "text") -> Column:
    """64-bit hash of a text. With the document id it names a row, also where ids repeat or are NULL."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def word_count(text: Column | str = "text") -> Column:
    """Number of words; NULL and empty texts have none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of each text of an Arrow column; NULL becomes empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def each_text(column: pa.ChunkedArray | pa.Array, rows: int = ROWS) -> Iterator[bytes]:
    """The same one by one, with few of them held at a time."""
    for lo in range(0, len(column), rows):
        yield from byte_texts(column.slice(lo, rows))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph: one row (node, root) per node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``; loops, repeats and NULLs
    are ignored. Every node takes the smallest of its neighbours and itself
    under an order that a random mask changes each round, the graph is
    contracted along these choices, and rounds go on until no edge is left:
    about half the nodes go each round, whatever the shape. Minima combine
    map-side; joins on a hub's label are plain equi-joins that Spark can split.
    ``root`` is some node of the component, the same for all of its nodes.
    """
    spark = edges.sparkSession
    rest = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    maps, draw = [], random.Random(42)
    while not rest.isEmpty():
        mask = F.lit(draw.getrandbits(63))
        ends = rest.select("a", "b").union(rest.select("b", "a"))
        lead = ends.groupBy("a").agg(F.min(F.col("b").bitwiseXOR(mask)).alias("m"))
        chosen = stored(lead.select(F.col("a").alias("node"), F.least("m", F.col("a").bitwiseXOR(mask)).bitwiseXOR(mask).alias("root")), f"{name}-choice")
        maps.append(chosen)
        left, right = chosen.select(F.col("node").alias("a"), F.col("root").alias("ra")), chosen.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = rest.join(left, "a").join(right, "b").where("ra <> rb")
        rest = stored(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-edges")
    if not maps:
        return spark.createDataFrame([], "node long, root long")
    # A root that is a node of a later round moves on to that round's root.
    found = maps[0]
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = stored(found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), f"{name}-labels")
    return found
