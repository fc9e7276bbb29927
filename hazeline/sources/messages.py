"""Keyed JSON messages, the online snapshot and the alert log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import json_text
from ..operators.windows import latest_per_key

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_columns(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, NaN as NULL: what JSON readers expect."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(f.name, ISO_MICROS)
        elif isinstance(f.dataType, T.DoubleType):
            out[f.name] = F.nanvl(f.name, F.lit(None).cast("double"))
    return df.withColumns(out) if out else df


def to_messages(df: DataFrame, key: str = "station_id") -> DataFrame:
    """(key, value): value is the whole row as JSON, a missing key is ``unknown``."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("unknown")) if key in df.columns else F.lit("unknown")
    text = iso_columns(df)
    return text.select(k.alias("key"), json_text(*df.columns).alias("value"))


def publish(messages: DataFrame, topic: str, *, servers: str | None = None, path: str | None = None) -> None:
    """To a Kafka topic where brokers are given, else to JSON files of the same two columns."""
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        messages.write.mode("append").json(f"{path}/{topic}")


def online_snapshot(
    df: DataFrame, key: str, ts: str, computed_at: str, *, asof=None, fresh: str = "2 hours", ttl: str = "2 hours",
) -> DataFrame:
    """Newest row per station computed within ``fresh`` of ``asof``, as keyed JSON with an expiry."""
    recent = df if asof is None else df.where(F.col(computed_at) >= F.lit(asof) - F.expr(f"interval {fresh}"))
    latest = latest_per_key(recent, key, [ts, computed_at]).select(*df.columns)
    expiring = latest.withColumn("_expires", F.struct(F.col(computed_at) + F.expr(f"interval {ttl}")))
    return iso_columns(expiring).select(
        F.concat(F.lit("features:"), F.col(key).cast("string"), F.lit(":latest")).alias("key"),
        json_text(*df.columns).alias("value"),
        F.col("_expires.col1").alias("expires_at"),
    )


def latest_alerts(df: DataFrame, payload: str, schema: str, n: int = 50, ts: str = "timestamp_utc") -> DataFrame:
    """The newest n alert documents; malformed JSON is skipped."""
    events = df.select(F.from_json(payload, schema).alias("e")).where(f"e.{ts} is not null").select("e.*")
    return events.orderBy(F.col(ts).desc(), *[c for c in events.columns if c != ts]).limit(n)


def filter_alerts(df: DataFrame, stations=None, max_score: float | None = None) -> DataFrame:
    out = df
    if stations:
        out = out.where(F.col("station_id").isin(list(stations)))
    if max_score is not None:
        out = out.where(F.col("anomaly_score") <= max_score)
    return out
