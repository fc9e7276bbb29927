"""Exact top-k inner products by block-at-a-time pruning.

Vectors are ranged by id into blocks of ``BLOCK`` rows. A block holds its rows
(the forward index) and, per component, their largest and smallest value. For a
query the sum over components of the better of the two is an upper bound of
every score in the block. Blocks are taken in the order of their bounds and
scored through their rows until the bound falls below the k-th score so far.

Work is dealt as pairs of a query group and a shard of blocks; each pair gives
at most k rows per query, which are then merged by a ranking window.

Defined cases: NULL vectors and vectors with a NULL or non-finite component
take no part, nor do NULL ids; shorter vectors are as if filled up with zeros;
a query never finds rows with its own id; a repeated candidate row is found as
often as it is there, a repeated query id is one query (its smallest vector);
ties go to the smaller id; fewer than k candidates are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

TOP = 10
#: Rows of a block, blocks of a shard, and queries of a group.
BLOCK, SHARD, GROUP = 64, 128, 256
SCALE = 1024


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as doubles of whole value; NULL where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("double"))
    return F.when(vector.isNotNull() & ~F.exists(x, odd), whole)


def dense(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def exact_dot(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products. Doubles are exact below 2^53; beyond that Python's integers do it."""
    size = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    if size < 2 ** 53:
        return (queries @ rows.T).astype(np.int64)
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(q, r)) for r in rows] for q in queries], dtype=object)
    return exact.reshape(len(queries), len(rows))


def search_shard(qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, block: int) -> tuple[list[tuple[int, int, int]], int]:
    """(query, id, score) of each query's best k of one shard, and how many blocks were scored."""
    cuts = range(0, len(ids), block)
    highest = np.array([rows[a:a + block].max(axis=0) for a in cuts])
    lowest = np.array([rows[a:a + block].min(axis=0) for a in cuts])
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = exact_dot(up, highest) + exact_dot(down, lowest)
    found, scored = [], 0
    for q, (qid, query) in enumerate(zip(qids.tolist(), queries)):
        best: list[tuple[int, int]] = []  # (-score, id), sorted
        for b in np.argsort(-bounds[q], kind="stable").tolist():
            # A bound that equals the k-th score may still win a tie by a smaller id.
            if len(best) == k and bounds[q][b] < -best[-1][0]:
                break
            scored += 1
            a = b * block
            scores, own = exact_dot(query[None, :], rows[a:a + block])[0], ids[a:a + block]
            keep = own != qid
            if len(best) == k:
                keep &= scores >= -best[-1][0]
            new = list(zip((-scores[keep]).tolist(), own[keep].tolist()))
            if new:
                best = sorted(best + new)[:k]
        found += [(qid, i, -s) for s, i in best]
    return found, scored


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores among rows of another id."""

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col)).alias("v")).where("id is not null and v is not null")

    rows, asked = usable(vectors), stored(usable(queries).groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    # Ranges of ids: how many follows from a count, where they lie from Spark's own range sampling.
    shards = max(1, -(-rows.count() // (block * shard)))
    placed = rows.repartitionByRange(shards, "id", F.xxhash64("v")).sortWithinPartitions("id")

    def as_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, size = TaskContext.get().partitionId(), block * shard
        ids, held, piece = [], [], 0

        def row() -> pa.RecordBatch:
            width = max(map(len, held))
            blob = dense(held, width).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + piece], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                                               pa.array([blob], pa.binary()), pa.array([width], pa.int32())], names=["shard", "ids", "rows", "width"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                held.append(v)
                if len(ids) == size:
                    yield row()
                    ids, held, piece = [], [], piece + 1
        if ids:
            yield row()

    index = stored(placed.mapInArrow(as_shards, "shard long, ids binary, rows binary, width int"), "topk-index")
    groups = max(1, -(-asked.count() // group))
    dealt = asked.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    packed = stored(dealt.groupBy("g").agg(F.collect_list(F.struct("id", "v")).alias("queries")), "topk-groups")
    # Every group meets every shard once: a stated query set against all rows, in blocks. Groups travel, shards do not.
    pairs = index.select("shard").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(packed, "g").select("shard", "queries")
    work = index.join(pairs, "shard")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = {n: batch.column(n)[r].as_py() for n in ("queries", "ids", "rows", "width")}
                ids = np.frombuffer(one["ids"], np.int64)
                matrix = np.frombuffer(one["rows"]).reshape(len(ids), one["width"])
                width = max([one["width"], *(len(q["v"]) for q in one["queries"])])
                matrix = np.pad(matrix, ((0, 0), (0, width - one["width"])))
                qids = np.array([q["id"] for q in one["queries"]], np.int64)
                found, _ = search_shard(qids, dense([q["v"] for q in one["queries"]], width), ids, matrix, k, block)
                columns = list(zip(*found)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    best = work.select("queries", "ids", "rows", "width").mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
