"""Batch validation: constraint rules as data, failure rows, quarantine, gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ALLOWED_SOURCES, READING_BOUNDS, TRAINING_BOUNDS, WEATHER_BOUNDS


@dataclass(frozen=True)
class Rule:
    """One check of one column. ``kind`` is not_null, in_range, isin or str_length."""

    column: str
    kind: str
    args: tuple = ()

    def broken(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_range":
            return c.isNotNull() & ~c.between(*self.args)
        if self.kind == "isin":
            return c.isNotNull() & ~c.isin(*self.args)
        if self.kind == "str_length":
            return c.isNotNull() & ~F.length(c).between(*self.args)
        raise ValueError(self.kind)


def _ranges(bounds: dict[str, tuple[float, float]]) -> list[Rule]:
    return [Rule(c, "in_range", b) for c, b in bounds.items()]


READING_RULES = [
    *[Rule(c, "not_null") for c in ("station_id", "source", "lat", "lon", "timestamp_utc")],
    Rule("station_id", "str_length", (1, 100)), Rule("source", "isin", tuple(ALLOWED_SOURCES)),
    *_ranges(READING_BOUNDS),
]
WEATHER_RULES = [*[Rule(c, "not_null") for c in ("lat", "lon", "timestamp_utc")], *_ranges(WEATHER_BOUNDS)]
TRAINING_RULES = [*[Rule(c, "not_null") for c in ("station_id", "timestamp_utc")], *_ranges(TRAINING_BOUNDS)]


def _broken_rules(rules: list[Rule]) -> Column:
    found = [
        F.when(r.broken(), F.struct(
            F.lit(r.column).alias("column"), F.lit(r.kind).alias("check"), F.col(r.column).cast("string").alias("value")))
        for r in rules
    ]
    return F.array_compact(F.array(*found))


def check_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``failures``: every broken rule of the row, in rule order."""
    return df.withColumn("failures", _broken_rules(rules))


def failures(df: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """Long form (keys, column, check, value), all failures."""
    return check_rows(df, rules).select(*keys, F.inline("failures"))


def validate(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their failures)."""
    checked = check_rows(df, rules)
    clean = F.size("failures") == 0
    return checked.where(clean).drop("failures"), checked.where(~clean)


def failure_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Failures per rule. Every rule has a row, with 0 when nothing broke: one scan, one row per task."""
    sums = df.agg(*[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(r.column).alias("column"), F.lit(r.kind).alias("check"), F.col(f"r{i}").alias("n_failures"))
        for i, r in enumerate(rules)])
    return sums.select(F.inline(rows))


def reading_gates(df: DataFrame, minimum: float = 0.5) -> DataFrame:
    """Share of rows with PM2.5 or PM10 and whether it exceeds the minimum."""
    share = F.avg((F.col("pm25").isNotNull() | F.col("pm10").isNotNull()).cast("int"))
    return df.agg(share.alias("present_share"), (share > minimum).alias("present_ok"))


def training_gates(
    df: DataFrame, critical=("pm25_24h_mean", "pm25_lag_1h"), frozen: str = "pm25_lag_1h",
    minimum: float = 0.7, deviation: float = 0.01, few: int = 10,
) -> DataFrame:
    """Null-flood gate (lowest non-null share) and frozen-sensor gate (standard deviation)."""
    shares = [F.avg(F.col(c).isNotNull().cast("int")) for c in critical]
    lowest = F.least(*shares) if len(shares) > 1 else shares[0]
    n, sd = F.count(F.lit(1)), F.stddev_samp(frozen)
    return df.agg(
        n.alias("n_rows"), lowest.alias("lowest_share"), (lowest > minimum).alias("share_ok"),
        sd.alias("deviation"), F.when(n > few, F.coalesce(sd > deviation, F.lit(False))).otherwise(F.lit(True)).alias("moving_ok"))
