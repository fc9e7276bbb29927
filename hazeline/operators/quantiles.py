"""Exact linear-interpolated quantiles without gathering the values.

Spark's ``percentile`` keeps every distinct value in one buffer, so it is used
only up to a checked number of them. Beyond, an approximate pass chooses range
borders; counts per range then locate the ranks, and the few ranges that hold
them are ranked exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stored

SMALL = 1_000_000
RANGES = 512
STRIDE = 23


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n) of the non-null values, kept in the shared folder for several passes."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return stored(counts, "value-counts")


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """(group, prob_index, quantile) of the non-null values of each group.

    Groups are few (a list of features or models); rows per group may be any
    number. Equal values are combined first, so one value holding most rows
    stays one row.
    """
    return quantiles_of_counts(value_counts(df, group, value), group, value, "n", probs)


def quantiles_of_counts(
    counts: DataFrame, group: str, value: str, n: str, probs: Sequence[float], *, small: int = SMALL, ranges: int = RANGES,
) -> DataFrame:
    """Quantiles of counted values: Spark's own aggregate up to ``small`` distinct values, ranges beyond."""
    present = counts.where(F.col(n) > 0)
    if present.limit(small + 1).count() <= small:
        every = present.groupBy(group).agg(F.percentile(value, [float(p) for p in probs], F.col(n)).alias("_q"))
        return every.select(group, F.posexplode("_q").alias("prob_index", "quantile"))
    return _by_ranges(present.select(group, value, F.col(n).alias("_n")), group, value, probs, ranges)


def _by_ranges(counts: DataFrame, group: str, value: str, probs: Sequence[float], ranges: int) -> DataFrame:
    """One row of borders per group is broadcast; only ranges that hold a wanted rank are sorted."""
    steps = [i / ranges for i in range(1, ranges)]
    borders = counts.groupBy(group).agg(
        F.array_distinct(F.percentile_approx(value, steps, 10 * ranges)).alias("_edges"))
    borders = borders.withColumn("_coarse", F.filter("_edges", lambda e, i: i % STRIDE == STRIDE - 1))
    ranged = counts.join(F.broadcast(borders), group).select(group, value, "_n", _position(F.col(value)).alias("_range"))
    per_range = ranged.groupBy(group, "_range").agg(F.sum("_n").alias("_rows"))
    upto = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_range.select(
        group, "_range", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_start"), "_rows",
        F.sum("_rows").over(Window.partitionBy(group)).alias("_total"))
    # Zero-based ranks each probability needs, attached to the range holding them.
    wanted = placed.select(
        group, "_range", "_start", "_rows",
        F.posexplode(F.transform(F.array(*[F.lit(float(p)) for p in probs]),
                                 lambda p: p * (F.col("_total") - 1))).alias("prob_index", "_pos"))
    wanted = wanted.withColumn("_rank", F.explode(F.array_distinct(F.array(
        F.floor("_pos").cast("long"), F.ceil("_pos").cast("long")))))
    wanted = wanted.where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_rows")))
    needed = wanted.select(group, "_range", "_start").distinct()
    inside = ranged.join(F.broadcast(needed), [group, "_range"])
    run = Window.partitionBy(group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    spans = inside.select(
        group, "_range", value,
        (F.col("_start") + F.sum("_n").over(run)).alias("_end"), "_n")
    hit = wanted.join(spans, [group, "_range"]).where(
        (F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
    weight = F.col("_pos") - F.floor("_pos")
    low = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col(value)))
    high = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col(value)))
    return (
        hit.groupBy(group, "prob_index", "_pos").agg(low.alias("_lo"), high.alias("_hi"))
        .select(group, "prob_index", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * weight).alias("quantile"))
    )


def _position(value):
    """How many edges are at or below the value: every STRIDE-th edge first, then the rest."""
    skip = F.size(F.filter("_coarse", lambda e: e <= value)) * STRIDE
    return skip + F.size(F.filter(F.slice("_edges", skip + 1, F.lit(STRIDE - 1)), lambda e: e <= value))
