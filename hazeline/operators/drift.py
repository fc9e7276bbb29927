"""Distribution drift: PSI, profiles and the retrain decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import PSI_RETRAIN, PSI_WARNING
from ..functions.seasons import event_threshold
from ..session import stored
from .quantiles import exact_quantiles, quantiles_of_counts

FLOOR = 1e-3


def long_values(df: DataFrame, columns: Sequence[str], *keys: str) -> DataFrame:
    """(keys, feature, value) with NULL and NaN dropped."""
    as_double = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = as_double.unpivot(list(keys), list(columns), "feature", "value")
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def psi(base: DataFrame, current: DataFrame, columns: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Population stability index per feature, (feature, psi).

    Edges are the distinct deciles of the baseline with open ends; a baseline of
    at most two distinct values takes equal-width bins over both sides. Shares
    below 0.001 are raised to it. A feature empty on one side scores 0.
    """
    tagged = long_values(base.withColumn("_side", F.lit(0)), columns, "_side").unionByName(
        long_values(current.withColumn("_side", F.lit(1)), columns, "_side"))
    is_base = F.col("_side") == 0
    # One pass over the rows: how often each distinct value occurs on either side.
    counts = stored(tagged.groupBy("feature", "value").agg(
        F.count_if(is_base).alias("b"), F.count_if(~is_base).alias("c")), "psi-counts")
    deciles = quantiles_of_counts(counts, "feature", "value", "b", [i / n_bins for i in range(n_bins + 1)])
    edges = deciles.groupBy("feature").agg(F.array_sort(F.collect_set("quantile")).alias("deciles"))
    sides = counts.groupBy("feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count_if(F.col("b") > 0).alias("n_distinct"),
        F.sum("b").alias("n_base"), F.sum("c").alias("n_cur"))
    even = F.transform(F.sequence(F.lit(0), F.lit(n_bins)),
                       lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / F.lit(n_bins))
    plan = sides.join(edges, "feature", "left").select(
        "feature", "n_base", "n_cur", F.when(F.col("n_distinct") > 2, F.col("deciles")).otherwise(even).alias("edges"))
    # One row per feature, so at most len(columns) rows are broadcast.
    binned = counts.join(F.broadcast(plan), "feature").withColumn("bin", bin_index(F.col("value"), F.col("edges")))
    bins = binned.groupBy("feature", "bin", "n_base", "n_cur").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    share = lambda n, total: F.greatest(F.col(n) / F.col(total), F.lit(FLOOR))
    b, c = share("b", "n_base"), share("c", "n_cur")
    term = F.when((F.col("n_base") > 0) & (F.col("n_cur") > 0), (c - b) * F.ln(c / b)).otherwise(F.lit(0.0))
    scored = bins.groupBy("feature").agg(F.sum(term).alias("psi"))
    names = base.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(scored, "feature", "left").select("feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))


def bin_index(value: Column, edges: Column) -> Column:
    """1-based bin: half-open bins, the first and the last one take everything beyond."""
    at = F.size(F.filter(edges, lambda e: value >= e))
    return F.least(F.greatest(at, F.lit(1)), F.greatest(F.size(edges) - 1, F.lit(1)))


def psi_class(score: Column, warning: float = PSI_WARNING, retrain: float = PSI_RETRAIN) -> Column:
    return F.when(score < warning, "stable").when(score < retrain, "warning").otherwise("retrain")


def worst_feature(scores: DataFrame) -> DataFrame:
    """Highest PSI and its feature; ties take the first name."""
    top = scores.agg(F.min(F.struct((-F.col("psi")).alias("p"), "feature")).alias("m"))
    return top.select((-F.col("m.p")).alias("max_psi"), F.col("m.feature").alias("worst_feature"))


def retrain_decision(max_psi: Column, rmse_degraded: Column, event: Column) -> dict[str, Column]:
    """Strictly above the (event-relaxed) threshold, or degraded."""
    limit = event_threshold(event)
    return {
        "effective_threshold": limit,
        "psi_drift": max_psi > limit,
        "should_retrain": (max_psi > limit) | F.coalesce(rmse_degraded, F.lit(False)),
    }


def profile(df: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Rows, missing, mean, deviation, range and quartiles per split and column."""
    as_double = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = as_double.unpivot(list(by), list(columns), "feature", "value")
    stats = rows.groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    group = F.to_json(F.struct(*by, "feature"))
    quartiles = exact_quantiles(rows.withColumn("_g", group), "_g", "value", [0.25, 0.5, 0.75])
    wide = quartiles.groupBy("_g").agg(*[
        F.max(F.when(F.col("prob_index") == i, F.col("quantile"))).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    return stats.withColumn("_g", group).join(wide, "_g", "left").drop("_g")


def first_last_split(df: DataFrame, order: Sequence[str], n: int = 168) -> DataFrame:
    """First n rows as reference and last n as current; short tables are cut in halves.

    Both ends are bounded top-n reads.
    """
    total = df.limit(n + 1).count()
    head, tail = (n, n) if total > n else (total // 2, total - total // 2)
    first = df.orderBy(*order).limit(head).withColumn("split", F.lit("reference"))
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(tail).withColumn("split", F.lit("current"))
    return first.unionByName(last)
