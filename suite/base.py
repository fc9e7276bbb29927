"""How the shared tables stand in for readings, weather and service logs.

The same derivations are written twice, as frames and as SQL, so that both
sides of a check start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazeline.session import ready
from hazeline.sources.tables import default_calendar, default_wards, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(ready(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


def r6(c: Column | str) -> Column:
    """Six decimals; the shift keeps exact halves (means of cents) off the rounding edge."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-8, 6)


def q6(expr: str) -> str:
    return f"round(({expr}) + 1e-8, 6)"


def rounded(df: DataFrame, *skip: str) -> DataFrame:
    """All double columns to six decimals."""
    return df.withColumns({n: r6(n) for n, t in df.dtypes if t == "double" and n not in skip})


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def as_readings(e: DataFrame) -> DataFrame:
    """One reading per event: users are stations, values PM2.5, the property PM10."""
    return e.select(
        "event_id", F.concat(F.lit("st_"), F.col("user_id")).alias("station_id"), F.col("event_type").alias("source"),
        F.col("ts").alias("timestamp_utc"), F.col("value").alias("pm25"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("pm10"),
        (27.60 + (F.col("user_id") % 20) * 0.01).alias("lat"), (85.20 + (F.col("user_id") % 25) * 0.01).alias("lon"))


def readings(spark, folder) -> DataFrame:
    return as_readings(events(spark, folder))


READINGS = """readings AS (
  SELECT event_id, 'st_' || user_id AS station_id, event_type AS source, ts AS timestamp_utc, value AS pm25,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS pm10,
         CAST(27.60 AS DOUBLE) + (user_id % 20) * CAST(0.01 AS DOUBLE) AS lat,
         CAST(85.20 AS DOUBLE) + (user_id % 25) * CAST(0.01 AS DOUBLE) AS lon
  FROM events)"""


def hourly(spark, folder) -> DataFrame:
    """Dense hourly series, one per source."""
    return readings(spark, folder).groupBy("source", F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz").alias("timestamp_utc")).agg(
        r6(F.avg("pm25")).alias("pm25"), r6(F.avg("pm10")).alias("pm10"))


HOURLY = f"""{READINGS},
hourly AS (
  SELECT source, date_trunc('hour', timestamp_utc) AS timestamp_utc, {q6('avg(pm25)')} AS pm25, {q6('avg(pm10)')} AS pm10
  FROM readings GROUP BY 1, 2)"""


def weather(spark, folder) -> DataFrame:
    """Weather 20 minutes past each hour that has readings enough."""
    return readings(spark, folder).groupBy(F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.min("lat").alias("lat"), F.min("lon").alias("lon"),
        r6(F.avg("pm25") / 10).alias("temp_c"), r6(F.avg("pm10")).alias("humidity_pct"),
        (F.max("pm10") / 2).alias("wind_speed_kmh"), r6(F.avg("pm10") * 3.6).alias("wind_dir_deg"),
        r6(F.sum("pm25") / 1000).alias("precip_mm"), (850 + F.min("pm10")).alias("pressure_hpa"),
    ).where("n >= 12").select((F.col("h") + F.expr("interval 20 minutes")).alias("timestamp_utc"), "lat", "lon",
        "temp_c", "humidity_pct", "wind_speed_kmh", "wind_dir_deg", "precip_mm", "pressure_hpa")


WEATHER = f"""{READINGS},
weather AS (
  SELECT date_trunc('hour', timestamp_utc) + INTERVAL 20 MINUTE AS timestamp_utc, min(lat) AS lat, min(lon) AS lon,
         {q6('avg(pm25) / 10')} AS temp_c, {q6('avg(pm10)')} AS humidity_pct, max(pm10) / 2 AS wind_speed_kmh,
         {q6('avg(pm10) * 3.6')} AS wind_dir_deg, {q6('sum(pm25) / 1000')} AS precip_mm, 850 + min(pm10) AS pressure_hpa
  FROM readings GROUP BY date_trunc('hour', timestamp_utc) HAVING count(*) >= 12)"""


def faulty(df: DataFrame) -> DataFrame:
    """Readings with zeros for low values and impossible ones for high values."""
    return df.withColumn("pm25", F.when(F.col("pm25") < 30, 0.0).when(F.col("pm25") > 250, F.col("pm25") + 800).otherwise(F.col("pm25")))


FAULTY = f"""{READINGS},
faulty AS (
  SELECT * REPLACE (CASE WHEN pm25 < 30 THEN 0.0 WHEN pm25 > 250 THEN pm25 + 800 ELSE pm25 END AS pm25) FROM readings)"""


def scored(spark, folder) -> DataFrame:
    """Hourly actuals with two forecasts: the previous value and the PM10 mean."""
    from hazeline.operators.windows import row_lags

    rows = row_lags(hourly(spark, folder), "source", "timestamp_utc", "pm25", [1], names=["p1"])
    return rows.where("p1 is not null").select(
        "source", "timestamp_utc", (F.hour("timestamp_utc") + 1).alias("horizon"), F.col("pm25").alias("y"), "p1", F.col("pm10").alias("p2"))


SCORED = f"""{HOURLY},
scored AS (
  SELECT * FROM (
    SELECT source, timestamp_utc, hour(timestamp_utc) + 1 AS horizon, pm25 AS y,
           lag(pm25) OVER (PARTITION BY source ORDER BY timestamp_utc) AS p1, pm10 AS p2
    FROM hourly) WHERE p1 IS NOT NULL)"""


def wards(spark) -> DataFrame:
    return default_wards(spark)


def calendar(spark) -> DataFrame:
    return default_calendar(spark)


def ward_values_sql() -> str:
    from hazeline.constants import WARDS, WARD_NAME

    rows = ", ".join(f"({i}, '{WARD_NAME.format(i)}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for i, lat, lon in WARDS)
    return f"wards AS (SELECT * FROM (VALUES {rows}) t(ward_id, ward_name, lat, lon))"
