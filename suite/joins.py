"""J: as-of, calendar, ward and alignment joins, and the whole feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.constants import (
    CENTER_LAT, CENTER_LON, DASHAIN_DAYS, DASHAIN_STARTS, HOLIDAY_YEARS, INDRA_JATRA, LAG_ROWS, MEAN_WINDOWS_H,
    MOVING_HOLIDAYS, STD_WINDOWS_H, TIHAR_DAYS, TIHAR_STARTS, WEATHER_COLUMNS, YEARLY_HOLIDAYS,
)
from hazeline.operators.asof import nearest_asof
from hazeline.operators.calendar import add_calendar_flags
from hazeline.operators.metrics import align
from hazeline.operators.spatial import semivariogram, ward_values, with_targets
from hazeline.plans.features import compute_features
from hazeline.sources.tables import table

from .base import READINGS, SCORED, WEATHER, calendar, hourly, q6, query, readings, rounded, scored, wards, ward_values_sql, weather
from .inputs import WARD_LATEST, ward_latest

TS = "timestamp_utc"
HOUR = 3_600_000_000
J1_COLUMNS = ["temp_c", "humidity_pct", "wind_speed_kmh", "wind_dir_deg", "precip_mm", "pressure_hpa"]

NEAREST = """
near AS (
  SELECT r.event_id, w.* EXCLUDE (timestamp_utc) FROM readings r JOIN w
    ON w.timestamp_utc BETWEEN r.timestamp_utc - INTERVAL 1 HOUR AND r.timestamp_utc + INTERVAL 1 HOUR
  QUALIFY row_number() OVER (PARTITION BY r.event_id ORDER BY abs(epoch_us(w.timestamp_utc) - epoch_us(r.timestamp_utc)), w.timestamp_utc DESC) = 1)"""

J1_SQL = f"""
WITH {WEATHER}, w AS (SELECT timestamp_utc, nullif(temp_c, round(temp_c)) AS temp_c, {', '.join(J1_COLUMNS[1:])} FROM weather), {NEAREST}
SELECT event_id, {', '.join(J1_COLUMNS)} FROM readings LEFT JOIN near USING (event_id)"""


@query("j1_nearest_asof", J1_SQL)
def j1(spark, folder):
    rows = nearest_asof(readings(spark, folder), weather(spark, folder), TS, J1_COLUMNS, HOUR)
    return rows.select("event_id", *J1_COLUMNS)


@query("j1_nearest_asof_window", J1_SQL)
def j1_window(spark, folder):
    """The form for a right side of any size."""
    rows = nearest_asof(readings(spark, folder), weather(spark, folder), TS, J1_COLUMNS, HOUR, method="window", salts=3)
    return rows.select("event_id", *J1_COLUMNS)


@query("j1_nearest_asof_by_key", """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase'), r AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT l.event_id, arg_min(r.value, abs(epoch_us(r.ts) - epoch_us(l.ts)) * 2 - CASE WHEN r.ts > l.ts THEN 1 ELSE 0 END) AS bought
FROM l LEFT JOIN r ON r.user_id = l.user_id AND r.ts BETWEEN l.ts - INTERVAL 12 HOUR AND l.ts + INTERVAL 12 HOUR GROUP BY 1""")
def j1_key(spark, folder):
    e = table(spark, folder, "events")
    left = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("bought"))
    return nearest_asof(left, right, "ts", ["bought"], 12 * HOUR, by="user_id", method="window", salts=1).select("event_id", "bought")


def _days(start: str, n: int, flag: str) -> str:
    return f"SELECT DATE '{start}' + CAST(i AS INTEGER) AS d, '{flag}' AS flag FROM range({n}) t(i)"


CALENDAR = "cal AS (" + " UNION ALL ".join(
    [_days(d, DASHAIN_DAYS, "is_dashain") for d in DASHAIN_STARTS] + [_days(d, TIHAR_DAYS, "is_tihar") for d in TIHAR_STARTS]
    + [_days(d, 1, "is_indra_jatra") for d in INDRA_JATRA] + [_days(d, 1, "is_public_holiday") for ds in MOVING_HOLIDAYS.values() for d in ds]
    + [_days(f"{y}-{d}", 1, "is_public_holiday") for y in range(HOLIDAY_YEARS[0], HOLIDAY_YEARS[1] + 1) for d in YEARLY_HOLIDAYS]) + ")"


@query("j2_calendar_flags", f"""
WITH {CALENDAR}, o AS (SELECT o_orderkey, o_orderdate + INTERVAL 28 YEAR AS t FROM orders)
SELECT o_orderkey, {', '.join(f"CAST(t AS DATE) IN (SELECT d FROM cal WHERE flag = '{f}') AS {f}" for f in ('is_tihar', 'is_dashain', 'is_indra_jatra'))},
       CAST(t AS DATE) IN (SELECT d FROM cal) AS is_public_holiday, month(t) BETWEEN 6 AND 9 AS is_monsoon,
       month(t) BETWEEN 3 AND 5 AS is_pre_monsoon, month(t) NOT BETWEEN 6 AND 9 AS is_brick_kiln_season FROM o""")
def j2(spark, folder):
    moved = table(spark, folder, "orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("interval 28 years")).alias("t"))
    return add_calendar_flags(moved, calendar(spark), "t").drop("t")


@query("j3_ward_join", f"WITH {WARD_LATEST} SELECT ward_id, ward_name, lat, lon, pm25, aqi_category FROM ward_cat")
def j3(spark, folder):
    return ward_values(wards(spark), ward_latest(spark, folder))


@query("j4_sensor_ward_distances", f"""
WITH {READINGS}, {ward_values_sql()}, d AS (
  SELECT event_id, ward_id, 2 * 6371.0 * asin(sqrt(pow(sin(radians(w.lat - r.lat) / 2), 2)
    + cos(radians(r.lat)) * cos(radians(w.lat)) * pow(sin(radians(w.lon - r.lon) / 2), 2))) AS km FROM readings r, wards w)
SELECT ward_id, count(*) AS n, {q6('min(km)')} AS nearest_km, {q6('avg(km)')} AS mean_km, {q6('max(km)')} AS farthest_km FROM d GROUP BY 1""")
def j4(spark, folder):
    """Readings are counted per place first: a place has one distance to each ward."""
    places = readings(spark, folder).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))
    d, n = with_targets(places, wards(spark)), F.sum("n")
    return rounded(d.groupBy("ward_id").agg(
        n.alias("n"), F.min("distance_km").alias("nearest_km"), (F.sum(F.col("distance_km") * F.col("n")) / n).alias("mean_km"),
        F.max("distance_km").alias("farthest_km")))


@query("j5_prediction_alignment", f"""
WITH {SCORED}
SELECT a.source, a.timestamp_utc, CAST(a.horizon AS INTEGER) AS horizon, a.y, b.p1, c.p2 FROM scored a
JOIN scored b ON a.source = b.source AND a.timestamp_utc = b.timestamp_utc AND a.horizon = b.horizon
JOIN scored c ON a.source = c.source AND a.timestamp_utc = c.timestamp_utc AND a.horizon = c.horizon""")
def j5(spark, folder):
    keys = ["source", TS, "horizon"]
    s = scored(spark, folder)
    return align(align(s.select(*keys, "p1"), s.select(*keys, "p2"), keys), s.select(*keys, "y"), keys)


@query("j6_semivariogram", f"""
WITH {READINGS}, m AS (
  SELECT date_trunc('hour', timestamp_utc) AS h, lat, lon, row_number() OVER (ORDER BY h, lat, lon) AS i, avg(pm25) AS z FROM readings GROUP BY h, lat, lon),
p AS (
  SELECT CAST(floor(sqrt(pow(a.lat - b.lat, 2) + pow(a.lon - b.lon, 2)) / 0.03 + 1e-9) AS INTEGER) AS bin,
         sqrt(pow(a.lat - b.lat, 2) + pow(a.lon - b.lon, 2)) AS d, pow(a.z - b.z, 2) AS s
  FROM m a JOIN m b ON a.h = b.h AND a.i < b.i)
SELECT bin, count(*) AS n_pairs, {q6('avg(s) / 2')} AS gamma, {q6('avg(d)')} AS distance FROM p WHERE bin < 10 GROUP BY 1""")
def j6(spark, folder):
    rows = readings(spark, folder).withColumn("h", F.date_trunc("hour", TS))
    return rounded(semivariogram(rows, "h", "pm25", 0.03, 10))


def _frame(h: int) -> str:
    return f"(PARTITION BY station_id ORDER BY timestamp_utc RANGE BETWEEN INTERVAL '{h * HOUR - 1} microseconds' PRECEDING AND CURRENT ROW)"


@query("features_all", f"""
WITH {WEATHER}, {CALENDAR}, w AS (
  SELECT timestamp_utc, temp_c, humidity_pct, wind_speed_kmh, sin(radians(wind_dir_deg)) AS wind_dir_sin, cos(radians(wind_dir_deg)) AS wind_dir_cos,
         precip_mm, pressure_hpa, sum(precip_mm) OVER (ORDER BY timestamp_utc RANGE BETWEEN INTERVAL '21599999999 microseconds' PRECEDING AND CURRENT ROW) AS precip_6h_cumulative
  FROM weather), {NEAREST},
s AS (SELECT *, {', '.join(f"{q6(f'avg(pm25) OVER {_frame(h)}')} AS pm25_{h}h_mean" for h in MEAN_WINDOWS_H)},
      {', '.join(f"{q6(f'stddev_samp(pm25) OVER {_frame(h)}')} AS pm25_{h}h_std" for h in STD_WINDOWS_H)},
      {', '.join(f"lag(pm25, {n}) OVER (PARTITION BY station_id ORDER BY timestamp_utc) AS pm25_lag_{n}h" for n in LAG_ROWS)} FROM readings)
SELECT station_id, timestamp_utc, pm25, pm10, lat, lon, CAST(hour(timestamp_utc) AS INTEGER) AS hour_of_day, CAST(isodow(timestamp_utc) - 1 AS INTEGER) AS day_of_week,
       {q6('sin(2 * pi() * hour(timestamp_utc) / 24)')} AS hour_sin, {q6('cos(2 * pi() * month(timestamp_utc) / 12)')} AS month_cos,
       {', '.join(f'pm25_{h}h_mean' for h in MEAN_WINDOWS_H)}, {', '.join(f'pm25_{h}h_std' for h in STD_WINDOWS_H)}, {', '.join(f'pm25_lag_{n}h' for n in LAG_ROWS)},
       {', '.join(f'{q6(c)} AS {c}' for c in WEATHER_COLUMNS)},
       CAST(timestamp_utc AS DATE) IN (SELECT d FROM cal) AS is_public_holiday, month(timestamp_utc) BETWEEN 6 AND 9 AS is_monsoon,
       CAST(CASE WHEN pm25 <= 12.0 THEN 0 WHEN pm25 <= 35.4 THEN 1 WHEN pm25 <= 55.4 THEN 2 WHEN pm25 <= 150.4 THEN 3 WHEN pm25 <= 250.4 THEN 4 ELSE 5 END AS INTEGER) AS aqi_us_category,
       {q6(f'''2 * 6371.0 * asin(sqrt(pow(sin(radians({CENTER_LAT} - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians({CENTER_LAT})) * pow(sin(radians({CENTER_LON} - lon) / 2), 2)))''')} AS station_distance_to_city_center_km
FROM s LEFT JOIN near USING (event_id)""")
def features_all(spark, folder):
    """The hourly feature table over every reading."""
    rows = compute_features(readings(spark, folder), weather(spark, folder), calendar(spark))
    return rounded(rows.select(
        "station_id", TS, "pm25", "pm10", "lat", "lon", "hour_of_day", "day_of_week", "hour_sin", "month_cos",
        *[f"pm25_{h}h_mean" for h in MEAN_WINDOWS_H], *[f"pm25_{h}h_std" for h in STD_WINDOWS_H], *[f"pm25_lag_{n}h" for n in LAG_ROWS],
        *WEATHER_COLUMNS, "is_public_holiday", "is_monsoon", "aqi_us_category", "station_distance_to_city_center_km"), "pm25", "pm10", "lat", "lon", *[f"pm25_lag_{n}h" for n in LAG_ROWS])
