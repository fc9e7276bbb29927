"""X and S9: streaming jobs, drained over the events table and compared with batch SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F, types as T

from hazeline import schemas
from hazeline.operators.iforest import fit_iforest
from hazeline.operators.quality import Rule
from hazeline.session import work_dir
from hazeline.sources.messages import to_messages
from hazeline.streaming import jobs

from .base import FAULTY, READINGS, as_readings, faulty, q6, query, readings, rounded

TS = "timestamp_utc"
WIRE = T.StructType([f for f in schemas.READING.fields if f.name != "ingested_at"])
RULES = [Rule("station_id", "not_null"), Rule("lat", "in_range", (20.0, 35.0)), Rule("pm25", "in_range", (0.0, 200.0))]


def reading_stream(spark, folder):
    return as_readings(jobs.stream_table(spark, folder, "events"))


def message_stream(spark, folder):
    """Readings on the wire: keyed JSON, with every field of a stored reading."""
    rows = reading_stream(spark, folder)
    return to_messages(rows.select("station_id", "source", "lat", "lon", TS, "pm25", "pm10"))


#: Rows of a file written for a micro-batch.
FILE_ROWS = 1_000_000


def in_batches(rows, n: int = 4):
    """A frame as a stream of ``n`` micro-batches in time order: each is one time range, in as many files as the longest needs."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, "batches")
    first, last = rows.agg(F.min(TS), F.max(TS)).first()
    cuts = [first + (last - first) * i / n for i in range(1, n)]
    part = sum((F.when(F.col(TS) >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    files = max(1, math.ceil(rows.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] / FILE_ROWS))
    for i in range(n):
        rows.where(part == i).repartition(files).write.mode("append").parquet(f"{path}/rows.parquet")
    return jobs.stream_table(spark, path, "rows", files)


@query("s9_stream_ingest", f"""
WITH {READINGS} SELECT station_id, source, lat, lon, timestamp_utc, pm25, pm10, CAST(timestamp_utc AS DATE) AS date, true AS stamped FROM readings WHERE pm25 <= 200""")
def s9(spark, folder):
    """Messages to the raw table, validated on the way."""
    valid, _ = jobs.ingest(message_stream(spark, folder), WIRE, RULES)
    stored = jobs.drain(valid, "raw-aqi", partition_by=["date"])
    return stored.select("station_id", "source", "lat", "lon", TS, "pm25", "pm10", "date", F.col("ingested_at").isNotNull().alias("stamped"))


@query("x1_stream_quarantine", f"""
WITH {READINGS} SELECT station_id, timestamp_utc, pm25, 'pm25' AS "column", 'in_range' AS "check" FROM readings WHERE pm25 > 200""")
def x1(spark, folder):
    """Messages that break a rule, with the rule."""
    _, held = jobs.ingest(message_stream(spark, folder), WIRE, RULES)
    rows = jobs.drain(held, "quarantine")
    return rows.select("station_id", TS, "pm25", F.col("failures")[0]["column"].alias("column"), F.col("failures")[0]["check"].alias("check"))


@query("x2_late_bound", """
WITH w AS (SELECT date_trunc('day', ts) AS window_start, count(*) AS n FROM events GROUP BY 1)
SELECT window_start, n FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def x2(spark, folder):
    """Daily counts a two-hour lateness bound lets become final."""
    rows = jobs.event_time(reading_stream(spark, folder), TS).groupBy(F.window(TS, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return jobs.drain(rows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n"), "late")


@query("x3_stream_dedup", f"WITH {READINGS} SELECT DISTINCT station_id, date_trunc('hour', timestamp_utc) AS timestamp_utc FROM readings")
def x3(spark, folder):
    """One row per station and hour; which one is arbitrary, so only the keys are returned."""
    rows = reading_stream(spark, folder).select("station_id", F.date_trunc("hour", TS).alias(TS), "pm25")
    kept = jobs.dedup_stream(rows, ["station_id"], TS, "40 days")
    return jobs.drain(kept.select("station_id", F.col(TS).cast("timestamp_ntz").alias(TS)), "dedup")


@query("x3_first_copies", f"""
WITH {READINGS}, h AS (SELECT station_id, date_trunc('hour', timestamp_utc) AS timestamp_utc, event_id, source, pm25 FROM readings)
SELECT * FROM h WHERE timestamp_utc <= (SELECT max(timestamp_utc) FROM h) - INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY station_id, timestamp_utc ORDER BY event_id) = 1""")
def x3_first(spark, folder):
    """The reading that arrived first for each station and hour, whole, once no earlier one can come."""
    rows = readings(spark, folder).select("station_id", TS, "event_id", "source", "pm25")
    hours = in_batches(rows).withColumn(TS, F.date_trunc("hour", TS).cast("timestamp_ntz"))
    return jobs.drain(jobs.dedup_first_stream(hours, ["station_id"], TS, ["event_id"]), "first-copies")


@query("x4_hourly_means", f"""
WITH {READINGS} SELECT source, date_trunc('hour', timestamp_utc) AS window_start, {q6('avg(pm25)')} AS mean, count(*) AS n FROM readings GROUP BY 1, 2
HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(timestamp_utc) FROM readings) - INTERVAL 2 HOUR""")
def x4(spark, folder):
    return rounded(jobs.drain(jobs.station_means(in_batches(readings(spark, folder)), "source", TS, "pm25"), "hourly-means"))


@query("x4_sliding_rates", f"""
WITH {READINGS}, m AS (SELECT source, date_trunc('minute', timestamp_utc) - INTERVAL 1 MINUTE * i AS window_start, pm25 FROM readings, range(5) t(i))
SELECT source, window_start, {q6('avg(pm25)')} AS mean, count(*) AS n FROM m GROUP BY 1, 2 HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(timestamp_utc) FROM readings) - INTERVAL 2 HOUR""")
def x4_sliding(spark, folder):
    """Five-minute means every minute, from one-minute panes."""
    return rounded(jobs.drain(jobs.sliding_means(reading_stream(spark, folder), "source", TS, "pm25"), "sliding-means"))


@query("x5_stream_faults", f"""
WITH {FAULTY}, z AS (
  SELECT *, pm25 = 0 AND lag(pm25, 1) OVER w = 0 AND lag(pm25, 2) OVER w = 0 AS stuck FROM faulty WINDOW w AS (PARTITION BY station_id ORDER BY timestamp_utc))
SELECT station_id, strftime(timestamp_utc, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, pm25 AS value,
       CASE WHEN pm25 > 999 THEN 'sensor_fault_impossible_value' ELSE 'sensor_fault_stuck_zero' END AS alert_type FROM z WHERE stuck OR pm25 > 999""")
def x5(spark, folder):
    path = work_dir(spark, "faults")
    jobs.fault_stream(in_batches(faulty(readings(spark, folder))), path).awaitTermination()
    return spark.read.parquet(f"{path}/alerts").select("station_id", TS, "value", "alert_type")


@query("x6_stream_anomalies")
def x6(spark, folder):
    """A forest trained on the table scores the stream."""
    forest = fit_iforest(readings(spark, folder), ["pm25", "pm10"], trees=50)
    return rounded(jobs.drain(jobs.score_stream(reading_stream(spark, folder), forest), "stream-alerts"))


@query("x7_latest_state", f"""
WITH {READINGS}, l AS (SELECT station_id, timestamp_utc, pm25 FROM readings QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC) = 1)
SELECT station_id, CASE WHEN timestamp_utc + INTERVAL 2 HOUR + INTERVAL 10 MINUTE >= (SELECT max(timestamp_utc) FROM readings) THEN coalesce(nullif(pm25, 0), 50.0) ELSE 50.0 END AS served FROM l""")
def x7(spark, folder):
    """Newest value per station over several micro-batches; one that has been expired for long is served as the default."""
    path, rows = work_dir(spark, "latest"), readings(spark, folder).select("station_id", TS, "pm25")
    jobs.latest_stream(in_batches(rows), path, "station_id", TS, ties=["pm25"]).awaitTermination()
    now = rows.agg(F.max(TS)).first()[0]
    return jobs.served_values(rows.select("station_id").distinct(), jobs.latest_rows(spark, path), now, "station_id", "pm25")


@query("x7_stations_in_state", """
WITH l AS (SELECT 'st_' || user_id AS station_id, max(ts) AS timestamp_utc FROM events GROUP BY 1)
SELECT station_id, timestamp_utc FROM l
WHERE epoch_ms(timestamp_utc + INTERVAL 130 MINUTE) + 1 > epoch_ms((SELECT max(ts) FROM events)) - 7200000""")
def x7_kept(spark, folder):
    """Stations whose newest row is still in the state when the stream ends: those expired for long are gone from it."""
    path, rows = work_dir(spark, "latest"), readings(spark, folder).select("station_id", TS, "pm25")
    jobs.latest_stream(in_batches(rows), path, "station_id", TS, ties=["pm25"]).awaitTermination()
    return jobs.latest_rows(spark, path).select("station_id", TS)


@query("x8_silent_stations", """
WITH n AS (SELECT DISTINCT user_id, ts FROM events), g AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM n)
SELECT 'st_' || user_id AS station_id, ts AS last_seen, ts + INTERVAL 3 HOUR AS silent_since FROM g
WHERE (next IS NULL OR next - ts > INTERVAL 3 HOUR) AND epoch_us(ts + INTERVAL 3 HOUR) < (epoch_ms((SELECT max(ts) FROM events)) - 7200000) * 1000""")
def x8_silent(spark, folder):
    """Every silence of more than three hours, told by timers while it lasts."""
    rows = readings(spark, folder).select("station_id", TS)
    return jobs.drain(jobs.silence_stream(in_batches(rows), "station_id", TS), "silence")


@query("x8_activity_sessions", """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT 'st_' || user_id AS station_id, min(ts) AS session_start, max(ts) + INTERVAL 3 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k
HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def x8(spark, folder):
    return jobs.drain(jobs.activity_sessions(reading_stream(spark, folder), "station_id", TS), "sessions")
