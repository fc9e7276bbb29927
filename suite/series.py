"""W and T: per-station series operators, ordering and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.constants import CENTER_LAT, CENTER_LON
from hazeline.functions.geo import haversine_km
from hazeline.operators import windows as W
from hazeline.operators.drift import first_last_split
from hazeline.operators.forecasts import against_naive, baseline_forecasts
from hazeline.sources.messages import latest_alerts, to_messages
from hazeline.operators.faults import alert_rows

from .base import FAULTY, HOURLY, READINGS, WEATHER, faulty, hourly, q6, query, r6, readings, rounded, weather

TS = "timestamp_utc"


def frame(hours: int) -> str:
    return f"RANGE BETWEEN INTERVAL '{hours * 3600 * 10**6 - 1} microseconds' PRECEDING AND CURRENT ROW"


def over(fn: str, col: str, hours: int, part: str) -> str:
    return q6(f"{fn}({col}) OVER (PARTITION BY {part} ORDER BY timestamp_utc {frame(hours)})")


@query("w1_trailing_mean", f"""
WITH {READINGS}
SELECT event_id, {', '.join(f"{over('avg', 'pm25', h, 'station_id')} AS pm25_{h}h_mean" for h in (1, 3, 6, 12, 24))} FROM readings""")
def w1(spark, folder):
    spec = {f"pm25_{h}h_mean": ("mean", h) for h in (1, 3, 6, 12, 24)}
    rows = W.trailing(readings(spark, folder), "station_id", TS, "pm25", spec)
    return rounded(rows.select("event_id", *spec))


@query("w1_trailing_mean_by_source", f"""
WITH {READINGS}
SELECT event_id, {over('avg', 'pm25', 6, 'source')} AS mean_6h, {over('avg', 'pm25', 24, 'source')} AS mean_24h FROM readings""")
def w1_source(spark, folder):
    rows = W.trailing(readings(spark, folder), "source", TS, "pm25", {"mean_6h": ("mean", 6), "mean_24h": ("mean", 24)}, chunk_us=24 * W.HOUR_US)
    return rounded(rows.select("event_id", "mean_6h", "mean_24h"))


@query("w2_trailing_std", f"""
WITH {READINGS}
SELECT event_id, {', '.join(f"{over('stddev_samp', 'pm25', h, 'station_id')} AS pm25_{h}h_std" for h in (1, 6, 24))} FROM readings""")
def w2(spark, folder):
    spec = {f"pm25_{h}h_std": ("std", h) for h in (1, 6, 24)}
    return rounded(W.trailing(readings(spark, folder), "station_id", TS, "pm25", spec).select("event_id", *spec))


LAGS = (1, 3, 6, 12, 24, 48, 168)


@query("w3_row_lags", f"""
WITH {HOURLY}
SELECT source, timestamp_utc, {', '.join(f"lag(pm25, {n}) OVER (PARTITION BY source ORDER BY timestamp_utc) AS pm25_lag_{n}h" for n in LAGS)} FROM hourly""")
def w3(spark, folder):
    return W.row_lags(hourly(spark, folder), "source", TS, "pm25", LAGS).drop("pm25", "pm10")


@query("w3_row_lags_by_station", f"""
WITH {READINGS}
SELECT event_id, {', '.join(f"lag(pm25, {n}) OVER (PARTITION BY station_id ORDER BY timestamp_utc, event_id) AS lag_{n}" for n in (1, 24, 48))} FROM readings""")
def w3_station(spark, folder):
    rows = W.row_lags(readings(spark, folder), "station_id", TS, "pm25", [1, 24, 48], names=["lag_1", "lag_24", "lag_48"], ties=["event_id"])
    return rows.select("event_id", "lag_1", "lag_24", "lag_48")


@query("w3_time_lags", f"""
WITH {HOURLY}
SELECT h.source, h.timestamp_utc, a.pm25 AS pm25_at_1h, b.pm25 AS pm25_at_24h FROM hourly h
LEFT JOIN hourly a ON a.source = h.source AND a.timestamp_utc = h.timestamp_utc - INTERVAL 1 HOUR
LEFT JOIN hourly b ON b.source = h.source AND b.timestamp_utc = h.timestamp_utc - INTERVAL 24 HOUR""")
def w3_time(spark, folder):
    return W.time_lags(hourly(spark, folder), "source", TS, "pm25", [1, 24]).select("source", TS, "pm25_at_1h", "pm25_at_24h")


@query("w4_trailing_rain", f"""
WITH {WEATHER}
SELECT timestamp_utc, {q6(f"sum(precip_mm) OVER (ORDER BY timestamp_utc {frame(6)})")} AS precip_6h_cumulative FROM weather""")
def w4(spark, folder):
    rows = W.trailing(weather(spark, folder).withColumn("place", F.lit("city")), "place", TS, "precip_mm", {"precip_6h_cumulative": ("sum", 6)})
    return rounded(rows.select(TS, "precip_6h_cumulative"))


def copies(df):
    """Every reading twice; the copy arrives first where PM10 exceeds 50."""
    first = df.withColumn("ingested_at", F.col(TS) + F.expr("interval 1 minute"))
    shift = F.when(F.col("pm10") > 50, F.expr("interval 30 seconds")).otherwise(F.expr("interval 2 minutes"))
    second = df.withColumn("pm25", F.col("pm25") + 1).withColumn("ingested_at", F.col(TS) + shift)
    return first.unionByName(second)


COPIES = f"""{READINGS},
copies AS (
  SELECT *, timestamp_utc + INTERVAL 1 MINUTE AS ingested_at FROM readings UNION ALL
  SELECT * REPLACE (pm25 + 1 AS pm25),
         timestamp_utc + CASE WHEN pm10 > 50 THEN INTERVAL 30 SECOND ELSE INTERVAL 2 MINUTE END AS ingested_at FROM readings)"""


@query("w5_dedup_first", f"""
WITH {COPIES}
SELECT event_id, pm25 FROM copies
QUALIFY row_number() OVER (PARTITION BY station_id, timestamp_utc ORDER BY ingested_at, source, event_id) = 1""")
def w5(spark, folder):
    rows = W.dedup_first(copies(readings(spark, folder)), ["station_id", TS], ["ingested_at", "source", "event_id"])
    return rows.select("event_id", "pm25")


@query("w5_coalesce_readings", f"""
WITH {READINGS}, long AS (
  SELECT station_id, timestamp_utc, pm25, NULL AS pm10, 1 AS arrival FROM readings WHERE pm25 > 20 UNION ALL
  SELECT station_id, timestamp_utc, NULL, pm10, 2 FROM readings UNION ALL
  SELECT station_id, timestamp_utc, 999.0, 0.0, 3 FROM readings)
SELECT station_id, timestamp_utc, arg_min(pm25, arrival) FILTER (WHERE pm25 IS NOT NULL) AS pm25,
       arg_min(pm10, arrival) FILTER (WHERE pm10 IS NOT NULL) AS pm10
FROM long GROUP BY 1, 2""")
def w5_coalesce(spark, folder):
    base = readings(spark, folder).select("station_id", TS, "pm25", "pm10")
    none = F.lit(None).cast("double")
    long = (
        base.where("pm25 > 20").withColumns({"pm10": none, "arrival": F.lit(1)})
        .unionByName(base.withColumns({"pm25": none, "arrival": F.lit(2)}))
        .unionByName(base.withColumns({"pm25": F.lit(999.0), "pm10": F.lit(0.0), "arrival": F.lit(3)})))
    return W.coalesce_readings(long, ["station_id", TS], ["pm25", "pm10"], ["arrival"])


@query("w6_latest_per_station", f"""
WITH {READINGS}
SELECT station_id, event_id, timestamp_utc, pm25 FROM readings
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC, event_id DESC) = 1""")
def w6(spark, folder):
    rows = readings(spark, folder).select("station_id", "event_id", TS, "pm25")
    return W.latest_per_key(rows, "station_id", [TS, "event_id"])


@query("w7_forward_fill", f"""
WITH {READINGS}, gaps AS (SELECT * REPLACE (CASE WHEN pm25 >= 40 THEN pm25 END AS pm25) FROM readings)
SELECT event_id, coalesce(last_value(pm25 IGNORE NULLS) OVER (
  PARTITION BY station_id ORDER BY timestamp_utc, event_id ROWS UNBOUNDED PRECEDING), 0) AS pm25 FROM gaps""")
def w7(spark, folder):
    gaps = readings(spark, folder).withColumn("pm25", F.when(F.col("pm25") >= 40, F.col("pm25")))
    rows = W.forward_fill(gaps, "station_id", TS, ["pm25"], 0.0, ties=["event_id"], chunk_us=48 * W.HOUR_US)
    return rows.select("event_id", "pm25")


@query("w8_sequences", f"""
WITH {HOURLY}, w AS (
  SELECT source, timestamp_utc,
         count(*) OVER i AS n_in, count(*) OVER o AS n_out, first_value(pm25) OVER i AS x_first, pm25 AS x_last,
         sum(pm25) OVER i AS x_sum, sum(pm10) OVER i AS x2_sum,
         first_value(pm25) OVER o AS y_first, last_value(pm25) OVER o AS y_last, sum(pm25) OVER o AS y_sum
  FROM hourly
  WINDOW i AS (PARTITION BY source ORDER BY timestamp_utc ROWS BETWEEN 47 PRECEDING AND CURRENT ROW),
         o AS (PARTITION BY source ORDER BY timestamp_utc ROWS BETWEEN 1 FOLLOWING AND 24 FOLLOWING))
SELECT source, timestamp_utc, x_first, x_last, {q6('x_sum')} AS x_sum, {q6('x2_sum')} AS x2_sum, y_first, y_last, {q6('y_sum')} AS y_sum
FROM w WHERE n_in = 48 AND n_out = 24""")
def w8(spark, folder):
    rows = W.sequences(hourly(spark, folder), "source", TS, ["pm25", "pm10"], "pm25", 48, 24)
    total = lambda a, i: F.aggregate(a, F.lit(0.0), lambda s, v: s + (v if i is None else v[i]))
    return rows.select(
        "source", TS, F.col("x")[0][0].alias("x_first"), F.col("x")[47][0].alias("x_last"),
        r6(total("x", 0)).alias("x_sum"), r6(total("x", 1)).alias("x2_sum"),
        F.col("y")[0].alias("y_first"), F.col("y")[23].alias("y_last"), r6(total("y", None)).alias("y_sum"))


@query("w9_stuck_zero", f"""
WITH {FAULTY}, runs AS (
  SELECT *, sum(CASE WHEN pm25 = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY station_id ORDER BY timestamp_utc, event_id ROWS UNBOUNDED PRECEDING) AS g FROM faulty)
SELECT event_id, station_id FROM (
  SELECT *, count(*) FILTER (WHERE pm25 = 0) OVER (PARTITION BY station_id, g ORDER BY timestamp_utc, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM runs)
WHERE pm25 = 0 AND streak >= 3""")
def w9(spark, folder):
    rows = W.stuck_rows(faulty(readings(spark, folder)), "station_id", TS, "pm25", 3, ties=["event_id"])
    return rows.select("event_id", "station_id")


@query("w10_station_place", f"""
WITH {READINGS}, gaps AS (
  SELECT station_id, timestamp_utc, event_id, CASE WHEN lat <> 27.61 THEN lat END AS lat, lon FROM readings),
f AS (SELECT station_id, CASE WHEN count(lat) = 0 THEN {CENTER_LAT} ELSE min(lat) END AS lat, min(lon) AS lon FROM gaps GROUP BY 1)
SELECT station_id, {q6('lat')} AS lat, {q6('lon')} AS lon, {q6(f'''2 * 6371.0 * asin(sqrt(pow(sin(radians({CENTER_LAT} - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians({CENTER_LAT})) * pow(sin(radians({CENTER_LON} - lon) / 2), 2)))''')} AS distance_km FROM f""")
def w10(spark, folder):
    gaps = readings(spark, folder).withColumn("lat", F.when(F.col("lat") != 27.61, F.col("lat")))
    rows = W.first_values(gaps, "station_id", TS, {"lat": CENTER_LAT, "lon": CENTER_LON}, ["event_id"])
    return rounded(rows.withColumn("distance_km", haversine_km(F.col("lat"), F.col("lon"), F.lit(CENTER_LAT), F.lit(CENTER_LON))))


@query("w11_chronological_split", f"""
WITH {READINGS}
SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc, event_id)
  <= floor(count(*) OVER (PARTITION BY station_id) * 0.8) THEN 'train' ELSE 'valid' END AS split FROM readings""")
def w11(spark, folder):
    return W.chronological_split(readings(spark, folder), "station_id", TS, 0.8, ["event_id"]).select("event_id", "split")


@query("w12_last_context", f"""
WITH {READINGS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC, event_id DESC) AS b FROM readings QUALIFY b <= 72)
SELECT station_id, {q6('sum(pm25)')} AS total, {q6('sum(pm25 * (73 - b))')} AS weighted, CAST(72 AS BIGINT) AS n FROM r GROUP BY 1""")
def w12(spark, folder):
    rows = W.last_context(readings(spark, folder), "station_id", TS, "pm25", 72, ["event_id"])
    sums = F.aggregate("context", F.lit(0.0), lambda s, v: s + v)
    weighted = F.aggregate(F.transform("context", lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v)
    return rows.select("station_id", r6(sums).alias("total"), r6(weighted).alias("weighted"), F.size("context").cast("long").alias("n"))


BASELINE = """
ranked AS (
  SELECT {key} AS k, pm25, row_number() OVER (PARTITION BY {key} ORDER BY timestamp_utc DESC, {tie} DESC) AS b,
         least(count(*) OVER (PARTITION BY {key}), 48) AS n FROM {src} QUALIFY b <= 48),
base AS (
  SELECT k, n, max(CASE WHEN b = (CASE WHEN n = 48 THEN 25 ELSE 1 END) THEN pm25 END) AS naive,
         avg(CASE WHEN n = 48 AND b > 24 THEN pm25 WHEN n < 48 AND b <= 24 THEN pm25 END) AS ma FROM ranked GROUP BY 1, 2),
pts AS (
  SELECT r.k, r.pm25 AS y, base.naive, base.ma, CASE WHEN r.n = 48 THEN s.pm25 ELSE base.naive END AS season
  FROM ranked r JOIN base USING (k) LEFT JOIN ranked s ON s.k = r.k AND s.b = r.b + 24 WHERE r.n < 48 OR r.b <= 24),
rm AS (
  SELECT k, sqrt(avg(pow(y - naive, 2))) AS rn, sqrt(avg(pow(y - ma, 2))) AS rm, sqrt(avg(pow(y - season, 2))) AS rs,
         avg(abs(y - naive)) AS an, avg(abs(y - ma)) AS am, avg(abs(y - season)) AS a_s FROM pts GROUP BY 1)
"""


def against_sql(key: str, tie: str, src: str, head: str) -> str:
    part = lambda m, r, a: (
        f"SELECT k AS {key}, '{m}' AS model, {q6(r)} AS rmse, {q6(a)} AS mae, "
        f"CASE WHEN rn > 0 THEN {q6(f'(1 - {r} / rn) * 100')} ELSE 0 END AS vs_naive_pct FROM rm")
    return f"WITH {head}, {BASELINE.format(key=key, tie=tie, src=src)} " + " UNION ALL ".join(
        [part("naive", "rn", "an"), part("moving_average", "rm", "am"), part("seasonal_naive", "rs", "a_s")])


@query("w13_baselines", against_sql("source", "source", "hourly", HOURLY))
def w13(spark, folder):
    return rounded(against_naive(baseline_forecasts(hourly(spark, folder), "source", TS, "pm25"), ["source"]))


@query("w13_baselines_by_station", against_sql("station_id", "event_id", "readings", READINGS))
def w13_station(spark, folder):
    return rounded(against_naive(baseline_forecasts(readings(spark, folder), "station_id", TS, "pm25", ["event_id"]), ["station_id"]))


@query("w14_first_last_split", f"""
WITH {READINGS}
SELECT * FROM (SELECT event_id, timestamp_utc, pm25, 'reference' AS split FROM readings ORDER BY timestamp_utc, event_id LIMIT 168)
UNION ALL
SELECT * FROM (SELECT event_id, timestamp_utc, pm25, 'current' AS split FROM readings ORDER BY timestamp_utc DESC, event_id DESC LIMIT 168)""")
def w14(spark, folder):
    return first_last_split(readings(spark, folder).select("event_id", TS, "pm25"), [TS, "event_id"], 168)


@query("t1_ordered_limit", f"WITH {READINGS} SELECT event_id, timestamp_utc, pm25, pm10 FROM readings ORDER BY timestamp_utc, event_id LIMIT 168")
def t1(spark, folder):
    return W.first_n(readings(spark, folder).select("event_id", TS, "pm25", "pm10"), [TS, "event_id"], 168)


ALERT_SCHEMA = "station_id string, timestamp_utc string, metric string, value double, anomaly_score double, alert_type string"


@query("t2_latest_alerts", f"""
WITH {READINGS}
SELECT station_id, strftime(timestamp_utc, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp_utc, pm25 AS value FROM readings
WHERE pm25 > 100 AND source <> 'error' ORDER BY 2 DESC, station_id LIMIT 50""")
def t2(spark, folder):
    high = readings(spark, folder).where("pm25 > 100")
    good = to_messages(alert_rows(high.where("source <> 'error'"), "statistical_anomaly")).select("value")
    # Alerts of one source are cut off in transit.
    cut = to_messages(alert_rows(high.where("source = 'error'"), "statistical_anomaly")).select(F.expr("substring(value, 1, 25)").alias("value"))
    return latest_alerts(good.unionByName(cut), "value", ALERT_SCHEMA, 50).select("station_id", TS, "value")


@query("t4_station_time_order", f"WITH {READINGS} SELECT station_id, timestamp_utc, event_id, pm25 FROM readings ORDER BY 1, 2, 3")
def t4(spark, folder):
    return readings(spark, folder).select("station_id", TS, "event_id", "pm25").orderBy("station_id", TS, "event_id")
