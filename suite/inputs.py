"""S, P and U: scans, feeds, sinks, filters and unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hazeline import schemas
from hazeline.functions.air import aqi_category, first_truthy
from hazeline.functions.geo import in_box
from hazeline.operators.faults import sensor_faults, statistical_alerts
from hazeline.operators.forecasts import history_from_lags
from hazeline.operators.spatial import heatmap_geojson, ward_values
from hazeline.operators.windows import latest_per_key, row_lags
from hazeline.session import work_dir
from hazeline.sources import feeds, tables
from hazeline.sources.messages import filter_alerts, online_snapshot, publish, to_messages

from .base import FAULTY, READINGS, events, faulty, query, readings, wards, ward_values_sql

TS = "timestamp_utc"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SQL_ISO = "%Y-%m-%dT%H:%M:%S.%f"


@query("s1_adhoc_sql", """
SELECT n_name, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2""")
def s1(spark, folder):
    return tables.run_sql(spark, """
        SELECT n_name, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
        WHERE o_orderdate >= TIMESTAMP_NTZ '1996-01-01' GROUP BY ALL""",
        **{t: tables.table(spark, folder, t) for t in ("orders", "customer", "nation")})


def city_documents(df):
    """Feed documents built from readings; errors become documents without data."""
    value = lambda c: F.struct(c.alias("v"))
    local = F.date_format(F.from_utc_timestamp(F.col(TS).cast("timestamp"), "+05:45"), "yyyy-MM-dd'T'HH:mm:ss")
    doc = F.struct(
        F.when(F.col("source") == "error", "error").otherwise("ok").alias("status"),
        F.struct(
            F.floor("pm10").cast("int").alias("aqi"),
            F.create_map(F.lit("pm25"), value(F.col("pm25")), F.lit("no2"), value(F.col("pm10") / 2)).alias("iaqi"),
            F.struct(F.concat(local, F.lit("+05:45")).alias("iso")).alias("time"),
            F.struct(F.array("lat", "lon").alias("geo")).alias("city")).alias("data"))
    return df.select(F.col("station_id").alias("name"), F.to_json(doc).alias("payload"),
                     F.when(F.col("source") == "view", F.lit(27.7)).alias("known_lat"), F.when(F.col("source") == "view", F.lit(85.3)).alias("known_lon"))


@query("s2_city_feed", f"""
WITH {READINGS}
SELECT 'aqicn_' || station_id AS station_id, 'aqicn' AS source, CASE WHEN source = 'view' THEN 27.7 ELSE lat END AS lat,
       CASE WHEN source = 'view' THEN 85.3 ELSE lon END AS lon, date_trunc('second', timestamp_utc) AS timestamp_utc,
       pm25, CAST(NULL AS DOUBLE) AS pm10, pm10 / 2 AS no2, CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS co,
       CAST(floor(pm10) AS INTEGER) AS aqi_us
FROM readings WHERE source <> 'error'""")
def s2(spark, folder):
    return feeds.parse_city_feed(city_documents(readings(spark, folder)), "payload", "name", "known_lat", "known_lon")


def sensor_documents(df):
    """One location document per reading with two sensors and one measurement each."""
    at = F.struct(F.struct(F.date_format(TS, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc")).alias("datetimeFrom"))
    sensor = lambda i, name, v: F.struct(
        F.lit(i).alias("id"), F.struct(F.lit(name).alias("name")).alias("parameter"),
        F.array(F.struct(v.alias("value"), at.alias("period"))).alias("measurements"))
    doc = F.struct(F.array(F.struct(
        F.col("event_id").alias("id"), F.col("station_id").alias("name"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("coordinates"),
        F.array(sensor(1, "PM25", F.col("pm25")), sensor(2, "pm10", F.col("pm10"))).alias("sensors"))).alias("results"))
    return df.select(F.to_json(doc).alias("payload"))


@query("s3_sensor_feed", f"""
WITH {READINGS}, base AS (SELECT CAST(event_id AS VARCHAR) AS station_id, 'openaq' AS source, lat, lon,
  date_trunc('second', timestamp_utc) AS timestamp_utc, pm25, pm10 FROM readings), n AS (SELECT CAST(NULL AS DOUBLE) AS x)
SELECT station_id, source, lat, lon, timestamp_utc, pm25, x AS pm10, x AS no2, x AS o3, x AS co, CAST(NULL AS INTEGER) AS aqi_us FROM base, n
UNION ALL
SELECT station_id, source, lat, lon, timestamp_utc, x, pm10, x, x, x, CAST(NULL AS INTEGER) FROM base, n""")
def s3(spark, folder):
    return feeds.parse_sensor_feed(sensor_documents(readings(spark, folder)), "payload")


@query("s4_hourly_feed", f"""
WITH {READINGS}
SELECT lat, lon, date_trunc('minute', timestamp_utc) + INTERVAL 1 HOUR * i AS timestamp_utc, pm25 / 10 + i AS temp_c,
       CASE WHEN i < 2 THEN pm10 END AS humidity_pct, CASE WHEN i < 1 THEN pm25 END AS wind_speed_kmh,
       CAST(NULL AS DOUBLE) AS wind_dir_deg, CAST(i AS DOUBLE) AS precip_mm, 850 + pm10 AS pressure_hpa
FROM readings, (VALUES (0), (1), (2)) t(i)""")
def s4(spark, folder):
    """Three-hour documents; one array is short, one shorter, one absent."""
    start = F.date_trunc("minute", TS)
    hour = lambda i: F.date_format(start + F.expr(f"interval {i} hours"), "yyyy-MM-dd'T'HH:mm")
    doc = F.struct(F.struct(
        F.array(*[hour(i) for i in range(3)]).alias("time"),
        F.array(*[F.col("pm25") / 10 + i for i in range(3)]).alias("temperature_2m"),
        F.array("pm10", "pm10").alias("relative_humidity_2m"), F.array("pm25").alias("wind_speed_10m"),
        F.array(*[F.lit(float(i)) for i in range(3)]).alias("precipitation"),
        F.array(*[850 + F.col("pm10")] * 3).alias("surface_pressure")).alias("hourly"))
    return feeds.parse_hourly_feed(readings(spark, folder).select("lat", "lon", F.to_json(doc).alias("payload")), "payload", "lat", "lon")


@query("s5_csv_dimension", """
SELECT CAST(n_nationkey AS INTEGER) AS ward_id, n_name AS ward_name, CAST(NULL AS DOUBLE) AS lat, CAST(n_regionkey AS DOUBLE) AS lon, CAST(0 AS BIGINT) AS n_missing_file FROM nation""")
def s5(spark, folder):
    path = work_dir(spark, "dimension")
    rows = tables.table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("ward_id"), F.col("n_name").alias("ward_name"), F.lit(None).cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"))
    tables.export(rows, path, "csv")
    absent = tables.read_csv_dimension(spark, path + "-absent", schemas.CALENDAR).count()
    return tables.read_csv_dimension(spark, path, schemas.WARDS).withColumn("n_missing_file", F.lit(absent).cast("long"))


@query("s6_append_readings", f"""
WITH {READINGS}
SELECT station_id, source, lat, lon, timestamp_utc, pm25, pm10, CAST(timestamp_utc AS DATE) AS day, true AS stamped FROM readings
UNION ALL
SELECT station_id, source, lat, lon, timestamp_utc, pm25, pm10, CAST(timestamp_utc AS DATE), true FROM readings WHERE source = 'view'""")
def s6(spark, folder):
    """Two appends into day folders, by name: the second frame has its columns in another order."""
    path = work_dir(spark, "raw")
    rows = readings(spark, folder)
    tables.append(rows, path, schemas.READING)
    tables.append(rows.where("source = 'view'").select(*reversed(rows.columns)), path, schemas.READING)
    stored = spark.read.parquet(path)
    return stored.select("station_id", "source", "lat", "lon", TS, "pm25", "pm10", F.col("date").alias("day"), F.col("ingested_at").isNotNull().alias("stamped"))


@query("s7_export", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def s7(spark, folder):
    path = work_dir(spark, "export")
    rows = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    tables.export(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("s8_keyed_messages", f"""
WITH {READINGS}
SELECT coalesce(CASE WHEN source <> 'view' THEN station_id END, 'unknown') AS key, to_json({{
  'station_id': CASE WHEN source <> 'view' THEN station_id END, 'timestamp_utc': strftime(timestamp_utc, '{SQL_ISO}'), 'pm25': pm25}})::VARCHAR AS value
FROM readings""")
def s8(spark, folder):
    rows = readings(spark, folder).select(F.when(F.col("source") != "view", F.col("station_id")).alias("station_id"), TS, "pm25")
    path = work_dir(spark, "topics")
    publish(to_messages(rows), "raw.aqi", path=path)
    return spark.read.schema("key string, value string").json(f"{path}/raw.aqi")


@query("s6_upsert_readings", f"""
WITH {READINGS} SELECT station_id, timestamp_utc, source, pm25 + CASE WHEN source = 'view' THEN 1 ELSE 0 END AS pm25, pm10, 2 AS runs FROM readings""")
def s6_upsert(spark, folder):
    """A run, a correction of some of its rows, and that correction again: each station and time stays once."""
    path, rows = work_dir(spark, "upserted"), readings(spark, folder)
    better = rows.where("source = 'view'").withColumn("pm25", F.col("pm25") + 1)
    for run, part in (("first", rows), ("better", better), ("better", better)):
        tables.upsert(part, path, schemas.READING, run=run)
    runs = F.lit(tables.finished_runs(spark, path).count()).alias("runs")
    return tables.read_day_table(spark, path, schemas.READING).select("station_id", TS, "source", "pm25", "pm10", runs)


@query("s10_online_snapshot", f"""
WITH {READINGS}, f AS (SELECT station_id, timestamp_utc, pm25, timestamp_utc + INTERVAL 5 MINUTE AS computed_at FROM readings)
SELECT 'features:' || station_id || ':latest' AS key, to_json({{'station_id': station_id, 'timestamp_utc': strftime(timestamp_utc, '{SQL_ISO}'),
  'pm25': pm25, 'computed_at': strftime(computed_at, '{SQL_ISO}')}})::VARCHAR AS value, computed_at + INTERVAL 2 HOUR AS expires_at
FROM f WHERE computed_at >= (SELECT max(computed_at) FROM f) - INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC) = 1""")
def s10(spark, folder):
    rows = readings(spark, folder).select("station_id", TS, "pm25", (F.col(TS) + F.expr("interval 5 minutes")).alias("computed_at"))
    newest = rows.agg(F.max("computed_at")).first()[0]
    return online_snapshot(rows, "station_id", TS, "computed_at", asof=newest)


@query("s11_csv_export", f"""
WITH {READINGS}
SELECT station_id, -pm25 / 100 AS anomaly_score, pm25 FROM readings
WHERE -pm25 / 100 <= -1.0""")
def s11(spark, folder):
    log = readings(spark, folder).withColumn("anomaly_score", -F.col("pm25") / 100)
    path = work_dir(spark, "anomalies")
    tables.export(filter_alerts(log, max_score=-1.0).select("station_id", "anomaly_score", "pm25"), path, "csv")
    return spark.read.csv(path, header=True, schema="station_id string, anomaly_score double, pm25 double")


def ward_latest(spark, folder):
    """Latest reading per ward; readings fall to wards by station number, low ones count as 0."""
    rows = readings(spark, folder)
    ward = F.concat(F.lit("ward_"), F.substring("station_id", 4, 20).cast("int") % 40)
    rows = rows.select(ward.alias("station_id"), TS, "event_id", F.when(F.col("pm25") < 20, 0.0).otherwise(F.col("pm25")).alias("pm25"), F.col("pm10").alias("pm25_1h_mean"))
    return latest_per_key(rows, "station_id", [TS, "event_id"])


WARD_LATEST = f"""{READINGS}, {ward_values_sql()},
latest AS (
  SELECT 'ward_' || (CAST(substr(station_id, 4) AS INTEGER) % 40) AS s, CASE WHEN pm25 < 20 THEN 0 ELSE pm25 END AS pm25, pm10 AS m
  FROM readings QUALIFY row_number() OVER (PARTITION BY s ORDER BY timestamp_utc DESC, event_id DESC) = 1),
ward_vals AS (
  SELECT ward_id, ward_name, lat, lon, CASE WHEN s IS NOT NULL THEN coalesce(nullif(latest.pm25, 0), m, 0) END AS pm25
  FROM wards LEFT JOIN latest ON s = 'ward_' || ward_id),
ward_cat AS (
  SELECT *, CASE WHEN coalesce(pm25, 0) = 0 THEN 'Unknown' WHEN pm25 <= 12.0 THEN 'Good' WHEN pm25 <= 35.4 THEN 'Moderate' WHEN pm25 <= 55.4 THEN 'USG'
         WHEN pm25 <= 150.4 THEN 'Unhealthy' WHEN pm25 <= 250.4 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS aqi_category FROM ward_vals)"""


@query("s12_heatmap_geojson", f"""
WITH {WARD_LATEST}
SELECT to_json({{'type': 'FeatureCollection', 'features': list({{'type': 'Feature',
  'properties': {{'ward_id': ward_id, 'ward_name': ward_name, 'pm25': pm25, 'aqi_category': aqi_category}},
  'geometry': {{'type': 'Point', 'coordinates': [lon, lat]}}}} ORDER BY ward_id), 'generated_at': '2024-01-31T00:00:00Z'}})::VARCHAR AS geojson FROM ward_cat""")
def s12(spark, folder):
    return heatmap_geojson(ward_values(wards(spark), ward_latest(spark, folder)), F.lit("2024-01-31T00:00:00Z"))


@query("s13_row_gate", "SELECT count(*) AS n_rows, count(*) >= 168 AS enough FROM events")
def s13(spark, folder):
    return tables.row_gate(events(spark, folder))


@query("p1_history", f"""
WITH {READINGS}
SELECT event_id, timestamp_utc, pm25 FROM readings
WHERE station_id = 'st_7' AND timestamp_utc >= TIMESTAMP '2024-01-05' AND timestamp_utc <= TIMESTAMP '2024-01-20 12:00:00' ORDER BY timestamp_utc""")
def p1(spark, folder):
    e = readings(spark, folder)
    return tables.history(e, TS, station="st_7", start=dt.datetime(2024, 1, 5), end=dt.datetime(2024, 1, 20, 12), order=True).select("event_id", TS, "pm25")


@query("p2_lookback", """
SELECT '7 days' AS span, event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY UNION ALL
SELECT '2 hours', event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR UNION ALL
SELECT '1 day', event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL 1 DAY""")
def p2(spark, folder):
    e = events(spark, folder)
    spans = [tables.history(e, "ts", lookback=s).select(F.lit(s).alias("span"), "event_id") for s in ("7 days", "2 hours")]
    return feeds.union_sources(*spans, tables.history(e, "ts", asof=dt.datetime(2024, 1, 20), lookback="1 day").select(F.lit("1 day").alias("span"), "event_id"))


@query("p3_bounding_box", f"""
WITH {READINGS}, moved AS (SELECT event_id, CASE WHEN source <> 'error' THEN lat + pm10 / 400 END AS lat, lon + pm10 / 500 AS lon FROM readings)
SELECT event_id FROM moved WHERE coalesce(lat, 0) BETWEEN 27.60 AND 27.80 AND coalesce(lon, 0) BETWEEN 85.20 AND 85.45""")
def p3(spark, folder):
    moved = readings(spark, folder).select("event_id", F.when(F.col("source") != "error", F.col("lat") + F.col("pm10") / 400).alias("lat"), (F.col("lon") + F.col("pm10") / 500).alias("lon"))
    return moved.where(in_box(F.col("lat"), F.col("lon"))).select("event_id")


@query("p4_sensor_rows", f"WITH {READINGS} SELECT event_id, station_id, lat, lon, pm25 FROM readings WHERE source <> 'signup' AND nullif(pm10, 50) IS NOT NULL")
def p4(spark, folder):
    rows = readings(spark, folder).withColumn("pm10", F.nullif("pm10", F.lit(50.0)))
    return tables.sensor_rows(rows, value="pm10", excluded="signup").select("event_id", "station_id", "lat", "lon", "pm25")


@query("p5_alert_filter", f"""
WITH {READINGS}
SELECT station_id, count(*) AS n, min(score) AS lowest FROM (SELECT station_id, -pm25 / 100 AS score FROM readings)
WHERE station_id IN ('st_1', 'st_2', 'st_3', 'st_4') AND score <= -0.5 GROUP BY 1""")
def p5(spark, folder):
    log = readings(spark, folder).select("station_id", (-F.col("pm25") / 100).alias("anomaly_score"))
    kept = filter_alerts(log, ["st_1", "st_2", "st_3", "st_4"], -0.5)
    return kept.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"), F.min("anomaly_score").alias("lowest"))


@query("p6_first_truthy", f"""
WITH {READINGS}, v AS (SELECT event_id, CASE WHEN pm25 < 30 THEN 0 WHEN pm25 < 60 THEN NULL ELSE pm25 END AS a, CASE WHEN pm10 > 10 THEN pm10 END AS b FROM readings)
SELECT event_id, coalesce(nullif(a, 0), b, 0) AS value FROM v""")
def p6(spark, folder):
    v = readings(spark, folder)
    a = F.when(F.col("pm25") < 30, 0.0).when(F.col("pm25") >= 60, F.col("pm25"))
    return v.select("event_id", first_truthy(a, F.coalesce(F.when(F.col("pm10") > 10, F.col("pm10")), F.lit(0.0))).alias("value"))


@query("p7_ensure_columns", f"WITH {READINGS} SELECT event_id, pm25, CAST(0.0 AS DOUBLE) AS temp_c, false AS is_tihar FROM readings")
def p7(spark, folder):
    rows = tables.ensure_columns(readings(spark, folder), {"pm25": -1.0, "temp_c": 0.0, "is_tihar": False})
    return tables.keep_available(rows, ["event_id", "pm25", "temp_c", "is_tihar", "no_such_column"])


@query("p8_null_policy", f"""
WITH {READINGS} SELECT event_id, pm25, coalesce(nullif(pm10, 50), 0) AS pm10 FROM readings WHERE source <> 'error'""")
def p8(spark, folder):
    rows = readings(spark, folder).select("event_id", F.when(F.col("source") != "error", F.col("pm25")).alias("pm25"), F.nullif("pm10", F.lit(50.0)).alias("pm10"))
    return rows.dropna(subset=["pm25"]).fillna(0.0, ["pm10"])


@query("p9_history_from_lags", f"""
WITH {READINGS}, l AS (
  SELECT event_id, list_filter([nullif(pm10, 50), lag(pm25, 1) OVER w, lag(pm25, 3) OVER w, lag(pm25, 6) OVER w], lambda x: x IS NOT NULL) AS h
  FROM readings WINDOW w AS (PARTITION BY station_id ORDER BY timestamp_utc, event_id))
SELECT event_id, CAST(len(h) AS INTEGER) AS n, h[1] AS first, h[len(h)] AS last FROM l WHERE len(h) >= 3""")
def p9(spark, folder):
    rows = row_lags(readings(spark, folder), "station_id", TS, "pm25", [1, 3, 6], ties=["event_id"])
    rows = rows.withColumn("h", history_from_lags([F.nullif("pm10", F.lit(50.0)), *[F.col(f"pm25_lag_{n}h") for n in (1, 3, 6)]])).where("h is not null")
    return rows.select("event_id", F.size("h").alias("n"), F.get("h", 0).alias("first"), F.element_at("h", -1).alias("last"))


@query("u1_union_sources", f"""
WITH {READINGS}
SELECT station_id, pm25, pm10, lat FROM readings WHERE source IN ('view', 'purchase') UNION ALL
SELECT station_id, NULL, pm10, NULL FROM readings WHERE source NOT IN ('view', 'purchase')""")
def u1(spark, folder):
    rows = readings(spark, folder)
    return feeds.union_sources(rows.where("source in ('view', 'purchase')").select("station_id", "pm25", "pm10", "lat"),
                               rows.where("source not in ('view', 'purchase')").select("pm10", "station_id"))


@query("u2_primary_else_fallback", f"""
WITH {READINGS}, b AS (SELECT *, date_trunc('hour', timestamp_utc) AS batch FROM readings)
SELECT event_id, batch FROM b WHERE source = 'view' UNION ALL
SELECT event_id, batch FROM b WHERE source <> 'view' AND batch NOT IN (SELECT batch FROM b WHERE source = 'view')""")
def u2(spark, folder):
    b = readings(spark, folder).select("event_id", "source", F.date_trunc("hour", TS).cast("timestamp_ntz").alias("batch"))
    return feeds.primary_else_fallback(b.where("source = 'view'").drop("source"), b.where("source <> 'view'").drop("source"), ["batch"])


@query("u3_alert_union", f"""
WITH {FAULTY}, z AS (
  SELECT *, CASE WHEN pm25 = 0 AND lag(pm25, 1) OVER w = 0 AND lag(pm25, 2) OVER w = 0 THEN true ELSE false END AS stuck
  FROM faulty WINDOW w AS (PARTITION BY station_id ORDER BY timestamp_utc, event_id)),
a AS (
  SELECT *, 'sensor_fault_stuck_zero' AS alert_type, -1.0 AS anomaly_score FROM z WHERE stuck UNION ALL
  SELECT *, 'sensor_fault_impossible_value', -1.0 FROM z WHERE pm25 > 999 UNION ALL
  SELECT *, 'statistical_anomaly', -pm10 / 100 FROM z WHERE pm10 > 95)
SELECT station_id, strftime(timestamp_utc, '{SQL_ISO}') AS timestamp_utc, 'pm25' AS metric, pm25 AS value, CAST(anomaly_score AS DOUBLE) AS anomaly_score, alert_type FROM a""")
def u3(spark, folder):
    rows = faulty(readings(spark, folder))
    marked = rows.withColumns({"is_anomaly": F.col("pm10") > 95, "anomaly_score": -F.col("pm10") / 100})
    return feeds.union_sources(sensor_faults(rows, ties=["event_id"]), statistical_alerts(marked))


@query("s2_nan_is_null", f"""
WITH {READINGS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE pm10 % 2 = 1) AS n_values, CAST(0 AS BIGINT) AS n_nan FROM readings""")
def s2_nan(spark, folder):
    """City documents whose PM2.5 is the bare word NaN in half of them; none comes through as a number."""
    value = F.when(F.col("pm10") % 2 == 1, F.lit("12.5")).otherwise(F.lit("NaN"))
    doc = F.concat(F.lit('{"status": "ok", "data": {"aqi": 1, "iaqi": {"pm25": {"v": '), value,
                   F.lit('}}, "time": {"iso": "2024-01-01T00:00:00+00:00"}, "city": {"geo": [1.0, 2.0]}}}'))
    rows = feeds.parse_city_feed(readings(spark, folder).select(doc.alias("payload"), F.col("station_id").alias("name")), "payload", "name")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count("pm25").alias("n_values"), F.count_if(F.isnan("pm25")).alias("n_nan"))
