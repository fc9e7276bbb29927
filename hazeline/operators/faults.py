"""Sensor faults and alert records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.air import impossible
from ..schemas import ALERT
from ..sources.messages import ISO_MICROS
from ..sources.tables import conform
from .windows import stuck_rows


def alert_rows(df: DataFrame, kind: str, ts: str = "timestamp_utc", value: str = "pm25", score: Column | None = None) -> DataFrame:
    """Rows in the alert schema."""
    return conform(df.select(
        F.coalesce(F.col("station_id").cast("string"), F.lit("unknown")).alias("station_id"),
        F.date_format(ts, ISO_MICROS).alias("timestamp_utc"),
        F.lit(value).alias("metric"), F.col(value).alias("value"),
        (F.lit(-1.0) if score is None else score).alias("anomaly_score"), F.lit(kind).alias("alert_type")), ALERT)


def sensor_faults(df: DataFrame, ts: str = "timestamp_utc", value: str = "pm25", n: int = 3, ties=(), **kw) -> DataFrame:
    """Stuck-at-zero rows (per station, in time order, then by ``ties`` or else the value) and impossible values."""
    ties = [*ties] or [value]
    stuck = stuck_rows(df.select(*dict.fromkeys(["station_id", ts, *ties, value])), "station_id", ts, value, n, ties=ties, **kw)
    high = df.where(impossible(F.col(value)))
    return alert_rows(stuck, "sensor_fault_stuck_zero", ts, value).unionByName(
        alert_rows(high, "sensor_fault_impossible_value", ts, value))


def statistical_alerts(scored: DataFrame, ts: str = "timestamp_utc", value: str = "pm25") -> DataFrame:
    return alert_rows(scored.where("is_anomaly"), "statistical_anomaly", ts, value, F.col("anomaly_score"))
