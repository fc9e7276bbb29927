"""Calendar membership flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.seasons import season_flags
from .chunks import small_side

FESTIVAL_FLAGS = ["is_tihar", "is_dashain", "is_indra_jatra"]


def calendar_days(calendar: DataFrame, flags=FESTIVAL_FLAGS) -> DataFrame:
    """One row per date with a boolean per flag; every entry is a public holiday."""
    return calendar.groupBy("date").agg(
        *[F.bool_or(F.col("flag_column_name") == f).alias(f) for f in flags], F.lit(True).alias("is_public_holiday"))


def add_calendar_flags(df: DataFrame, calendar: DataFrame, ts: str, tz: str = "UTC", flags=FESTIVAL_FLAGS) -> DataFrame:
    """Festival, holiday and season flags by date; the date is UTC unless ``tz`` says otherwise.

    The day table has one row per calendar date; it is broadcast after a count of
    its rows, so the readings are not shuffled by date.
    """
    local = F.col(ts) if tz == "UTC" else F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz)
    names = [*flags, "is_public_holiday"]
    days = calendar_days(calendar, flags).select(F.col("date").alias("_date"), *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.withColumn("_date", F.to_date(local)).join(small_side(days), "_date", "left")
    return joined.select(
        *df.columns, *[F.coalesce(f"_{n}", F.lit(False)).alias(n) for n in names],
        *[c.alias(n) for n, c in season_flags(local).items()])
