"""Time expressions: parts, cycles, microseconds and ISO normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def clock_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0), month, weekend flag and their cycles."""
    hour, month = F.hour(ts), F.month(ts)
    return {
        "hour_of_day": hour,
        "day_of_week": F.weekday(ts),
        "month": month,
        "is_weekend": F.weekday(ts) >= 5,
        **cycle(hour, 24, "hour"),
        **cycle(month, 12, "month"),
    }


def cycle(value: Column, period: int, prefix: str) -> dict[str, Column]:
    angle = 2 * F.pi() * value / F.lit(period)
    return {f"{prefix}_sin": F.sin(angle), f"{prefix}_cos": F.cos(angle)}


def direction(degrees: Column, prefix: str = "wind_dir") -> dict[str, Column]:
    return {f"{prefix}_sin": F.sin(F.radians(degrees)), f"{prefix}_cos": F.cos(F.radians(degrees))}


def parse_iso(text: Column) -> Column:
    """ISO text to a UTC TIMESTAMP_NTZ; text without a zone is taken as UTC.

    Feeds deliver times with or without seconds, with ``Z`` or with an offset.
    Seconds are added where absent, the one thing a plain cast does not accept;
    text that is no time becomes NULL.
    """
    full = F.regexp_replace(text, r"(T\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")
    return full.try_cast("timestamp").cast("timestamp_ntz")
