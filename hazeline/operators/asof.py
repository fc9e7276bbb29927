"""Nearest-in-time left join with a tolerance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.timefns import micros
from .chunks import as_list, time_chunk

LOOKUP_ROWS = 200_000
LOOKUP_PER_BUCKET = 64
TASK_ROWS = 4_000_000


def nearest_asof(
    left: DataFrame, right: DataFrame, ts: str, columns: Sequence[str], tolerance_us: int,
    *, by: str | Sequence[str] | None = None, method: str = "auto", chunk_us: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Attach the right row nearest in time, at most ``tolerance_us`` away.

    The right side has one row per (by, ts). A tie takes the later row, the
    tolerance is inclusive, and a matched row's NULLs are kept as they are.

    ``lookup``  the right side becomes arrays of candidates per time bucket and is
                joined by bucket.
    ``window``  both sides are sorted together inside (by, time chunk); any size. A
                chunk too full for one task is split by ``salts`` (measured unless
                given): each left row has one salt, right rows are in all of them.
    ``auto``    counts the right side; a lookup that fits is broadcast and the left
                side is not shuffled at all, else ``window``.
    """
    keys = as_list(by)
    if method == "auto" and lookup_fits(right, keys, ts, tolerance_us):
        return _lookup(left, right, keys, ts, columns, tolerance_us, F.broadcast)
    if method == "lookup":
        return _lookup(left, right, keys, ts, columns, tolerance_us)
    return _window(left, right, keys, ts, columns, tolerance_us, chunk_us or tolerance_us, salts)


def lookup_fits(right: DataFrame, keys: list[str], ts: str, tolerance_us: int) -> bool:
    """Size check of the right side: few rows in all and few per bucket, from one count per bucket."""
    per_bucket = right.groupBy(*keys, time_chunk(micros(F.col(ts)), tolerance_us).alias("_b")).count()
    size = per_bucket.agg(F.sum("count").alias("rows"), F.max("count").alias("fullest")).first()
    return (size["rows"] or 0) <= LOOKUP_ROWS and (size["fullest"] or 0) <= LOOKUP_PER_BUCKET


def _lookup(left, right, keys, ts, columns, tolerance_us, place=lambda table: table):
    us = micros(F.col(ts))
    home = time_chunk(us, tolerance_us)
    candidate = F.struct(us.alias("us"), *columns)
    table = (
        right.withColumn("_b", F.explode(F.sequence(home - 1, home + 1)))
        .groupBy(*keys, "_b").agg(F.collect_list(candidate).alias("_near"))
    )
    at = left.withColumns({"_us": us, "_b": home}).join(place(table), [*keys, "_b"], "left")
    # Smallest (distance, -time) wins: the nearest row and, on a tie, the later one.
    ranked = F.array_min(F.transform(
        F.filter("_near", lambda c: F.abs(c["us"] - F.col("_us")) <= tolerance_us),
        lambda c: F.struct(F.abs(c["us"] - F.col("_us")).alias("d"), (-c["us"]).alias("o"), c.alias("c"))))
    best = at.withColumn("_best", ranked)
    return best.select(*left.columns, *[F.col(f"_best.c.{c}").alias(c) for c in columns])


def salts_needed(left: DataFrame, keys: list[str], ts: str, chunk_us: int) -> int:
    """Splits of the fullest chunk, from one count per chunk."""
    fullest = (
        left.groupBy(*keys, time_chunk(micros(F.col(ts)), chunk_us).alias("_b")).count()
        .agg(F.max("count").alias("m")).first()["m"]
    )
    return -(-(fullest or 1) // TASK_ROWS)


def _window(left, right, keys, ts, columns, tolerance_us, chunk_us, salts):
    us = micros(F.col(ts))
    salts = salts or salts_needed(left, keys, ts, chunk_us)
    payload = F.struct(us.alias("us"), *columns)
    # Right rows are repeated in each chunk they can reach; left rows never are.
    r = right.select(
        *keys, us.alias("_us"), payload.alias("_r"),
        F.explode(F.sequence(time_chunk(us - tolerance_us, chunk_us), time_chunk(us + tolerance_us, chunk_us))).alias("_chunk"))
    r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    body = F.struct(*left.columns)
    l = left.select(*keys, us.alias("_us"), time_chunk(us, chunk_us).alias("_chunk"), body.alias("_l"))
    l = l.withColumn("_salt", F.pmod(F.xxhash64("_l"), F.lit(salts)).cast("int"))
    both = l.unionByName(r, allowMissingColumns=True)
    part = [*keys, "_chunk", "_salt"]
    # Rows sharing one time must all see the right row of that time: range frames.
    back = Window.partitionBy(*part).orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*part).orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, 0)
    seen = (
        both.withColumn("_prev", F.last("_r", ignorenulls=True).over(back))
        .withColumn("_next", F.last("_r", ignorenulls=True).over(ahead))
        .where("_l is not null")
    )
    gap_prev, gap_next = F.col("_us") - F.col("_prev.us"), F.col("_next.us") - F.col("_us")
    take_next = gap_next <= F.coalesce(gap_prev, F.lit(tolerance_us + 1))
    best = F.when(take_next & (gap_next <= tolerance_us), F.col("_next")).when(gap_prev <= tolerance_us, F.col("_prev"))
    return seen.withColumn("_best", best).select("_l.*", *[F.col(f"_best.{c}").alias(c) for c in columns])
