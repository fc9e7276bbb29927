"""Service-log aggregates: sliding rates, error counts, latency histograms and p95."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import LATENCY_BUCKETS


def sliding_rate(df: DataFrame, ts: str, by: Sequence[str], length_min: int = 5) -> DataFrame:
    """Requests per minute over sliding windows of ``length_min`` minutes, step one minute.

    Counts per minute come first; only those few rows are repeated in the windows.
    """
    minute = df.groupBy(*by, F.date_trunc("minute", ts).alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    spread = minute.withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(length_min - 1))))
    start = F.timestamp_micros(F.unix_micros(F.col("_m").cast("timestamp")) - F.col("_back").cast("long") * 60_000_000).cast("timestamp_ntz")
    rate = F.sum("_n") * 60.0 / (length_min * 60)
    return spread.groupBy(*by, start.alias("window_start")).agg(rate.alias("per_minute"))


def error_counts(df: DataFrame, is_error: Column, by: Sequence[str]) -> DataFrame:
    return df.where(is_error).groupBy(*by).agg(F.count(F.lit(1)).alias("n_errors"))


def latency_histogram(df: DataFrame, latency: str, by: Sequence[str], limits: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative counts per upper limit, the last one unlimited (``le`` = NULL)."""
    sums = df.groupBy(*by).agg(
        *[F.count_if(F.col(latency) <= le).alias(f"b{i}") for i, le in enumerate(limits)], F.count(latency).alias("b_all"))
    rows = [F.struct(F.lit(float(le)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, le in enumerate(limits)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("b_all").alias("cumulative")))
    return sums.select(*by, F.inline(F.array(*rows)))


def bucket_quantile(histogram: DataFrame, by: Sequence[str], q: float = 0.95) -> DataFrame:
    """Quantile interpolated inside its bucket; beyond the last limit it is that limit."""
    key = F.coalesce("le", F.lit(float("inf")))
    order = Window.partitionBy(*by).orderBy(key)
    rows = histogram.withColumns({
        "_total": F.max("cumulative").over(Window.partitionBy(*by)),
        "_below": F.coalesce(F.lag("cumulative").over(order), F.lit(0)),
        "_low": F.coalesce(F.lag("le").over(order), F.lit(0.0))})
    rank = q * F.col("_total")
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * (rank - F.col("_below")) / (F.col("cumulative") - F.col("_below"))
    hit = rows.where((F.col("cumulative") >= rank) & (F.col("_below") < rank))
    return hit.select(*by, F.when(F.col("le").isNull(), F.col("_low")).otherwise(inside).alias("quantile"))
