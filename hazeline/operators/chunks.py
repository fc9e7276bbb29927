"""Splitting ordered series so that no task holds a whole key.

A station may own a large share of all rows, so windows are never partitioned
by station alone. Two forms of split are used:

* time chunks: rows of one key and one span of time, plus the rows of the
  preceding span that a bounded look-back can reach;
* row blocks: rows of one key whose running number falls in one range, plus the
  neighbours that a bounded row offset can reach.

Both replicate only the borders, so the extra volume is (reach / size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.timefns import micros

HOUR_US = 3_600_000_000
CHUNK_US = 168 * HOUR_US
BLOCK_ROWS = 20_000
TASK_ROWS = 4_000_000


def as_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


SMALL_SIDE_ROWS = 100_000


def small_side(df: DataFrame, limit: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Broadcast a dimension of at most ``limit`` rows; leave a larger one to the join planner.

    The rows are counted, up to the limit, before the hint is given.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by key into the session's full number of shuffle partitions.

    Without a number, partitions of few bytes are merged, and groups that are
    small but costly in Python would run in one or two tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def time_chunk(us: Column, size_us: int = CHUNK_US) -> Column:
    return F.floor(us / F.lit(size_us)).cast("long")


def measured_chunk(df: DataFrame, key: str | Sequence[str], ts: str, reach_us: int = 0) -> int:
    """Chunk length that keeps the fullest (key, chunk) near ``TASK_ROWS`` rows.

    Between the reach, below which borders would outweigh the chunk, and a week.
    Costs one scan of key and time, counted map-side.
    """
    per_day = df.groupBy(*as_list(key), time_chunk(micros(F.col(ts)), 24 * HOUR_US).alias("_d")).count()
    fullest = per_day.agg(F.max("count").alias("m")).first()["m"] or 1
    return max(reach_us, min(CHUNK_US, 24 * HOUR_US * TASK_ROWS // fullest), HOUR_US // 60)


def with_time_halo(df: DataFrame, ts: str, reach_us: int, size_us: int = CHUNK_US, us: str = "_us") -> DataFrame:
    """Add ``_us``, ``_chunk`` and ``_own``; rows reaching into later chunks are repeated there."""
    stamped = df.withColumn(us, micros(F.col(ts)))
    home = time_chunk(F.col(us), size_us)
    last = time_chunk(F.col(us) + F.lit(max(reach_us - 1, 0)), size_us)
    spread = stamped.withColumn("_home", home).withColumn("_chunk", F.explode(F.sequence(F.col("_home"), last)))
    return spread.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")


def chunk_offsets(df: DataFrame, key: list[str], chunk: str) -> DataFrame:
    """Rows of the key before each chunk, from one small row per (key, chunk).

    Callers' rows are already partitioned by (key, chunk); the hint joins in place
    by hashing this side, whatever its size.
    """
    before = Window.partitionBy(*key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(*key)
    return (
        df.groupBy(*key, chunk).agg(F.count(F.lit(1)).alias("_n"))
        .select(*key, chunk,
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                F.sum("_n").over(total).alias("_total"))
        .hint("shuffle_hash")
    )


def numbered(
    df: DataFrame, key: str | Sequence[str], ts: str, ties: Sequence[str] = (),
    *, seq: str = "_seq", total: str | None = None, size_us: int | None = None,
) -> DataFrame:
    """Running row number per key in time order, without gathering a key in one task.

    Chunks are as long as the densest key allows, measured unless given.

    Rows are numbered inside (key, time chunk); chunk counts, one row per chunk,
    supply the number of rows before it.
    """
    keys = as_list(key)
    base = df.withColumn("_chunk", time_chunk(micros(F.col(ts)), size_us or measured_chunk(df, keys, ts)))
    local = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)
    rows = base.withColumn("_local", F.row_number().over(local))
    joined = rows.join(chunk_offsets(base, keys, "_chunk"), [*keys, "_chunk"])
    out = joined.withColumn(seq, F.col("_local") + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    drop = [c for c in ("_chunk", "_local", "_before", "_total") if c not in (seq, total)]
    return out.drop(*drop)


def with_row_halo(
    df: DataFrame, seq: str, before: int = 0, after: int = 0, size: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``_block`` and ``_own``; border rows are repeated in the neighbouring block.

    ``before`` rows of the preceding block and ``after`` rows of the following
    block are visible inside each block.
    """
    size = max(size, before, after)
    home = F.floor((F.col(seq) - 1) / F.lit(size)).cast("long")
    place = (F.col(seq) - 1) % F.lit(size)
    first = F.col("_home") - F.when(place < after, 1).otherwise(0)
    last = F.col("_home") + F.when(place >= size - before, 1).otherwise(0)
    spread = df.withColumn("_home", home)
    if before or after:
        spread = spread.withColumn("_block", F.explode(F.sequence(first, last)))
    else:
        spread = spread.withColumn("_block", F.col("_home"))
    return spread.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")


def over_rows(
    df: DataFrame, key: str | Sequence[str], ts: str, exprs, *, before: int = 0, after: int = 0,
    ties: Sequence[str] = (), size: int = BLOCK_ROWS, size_us: int | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Evaluate row-offset window expressions exactly, with block-sized partitions.

    ``exprs`` maps a block window (ordered by row number) to named columns.
    """
    keys = as_list(key)
    blocks = with_row_halo(numbered(df, keys, ts, ties, size_us=size_us), "_seq", before, after, size)
    window = Window.partitionBy(*keys, "_block").orderBy("_seq")
    out = blocks.withColumns(exprs(window)).where("_own")
    return out.drop(*[c for c in ("_seq", "_block", "_own") if c not in keep])
