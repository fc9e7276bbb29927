"""Whole jobs over the shared tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hazeline.plans import jobs
from hazeline.session import work_dir
from hazeline.sources.tables import default_calendar

from .base import READINGS, hourly, q6, query, readings, rounded, scored, ward_values_sql, wards
from .scores import DIRTY, A7_RULES, EVALUATIONS, dirty, evaluations

TS = "timestamp_utc"
ASOF = dt.datetime(2024, 1, 30, 12)


@query("flow_ingest", f"""
WITH {DIRTY}
SELECT source, count(*) FILTER (WHERE NOT bad) AS n_valid, count(*) FILTER (WHERE bad) AS n_held
FROM (SELECT source, ({' OR '.join(f'coalesce({w}, false)' for _, _, w in A7_RULES)}) AS bad FROM dirty) GROUP BY 1""")
def ingest(spark, folder):
    """Two sources united, checked and split."""
    rows = dirty(spark, folder)
    valid, held = jobs.ingest_readings(rows.where("source <> 'aqicn'"), rows.where("source = 'aqicn'"))
    both = valid.select("source", F.lit(1).alias("v"), F.lit(0).alias("h")).unionByName(held.select("source", F.lit(0).alias("v"), F.lit(1).alias("h")))
    return both.groupBy("source").agg(F.sum("v").alias("n_valid"), F.sum("h").alias("n_held"))


@query("flow_drift_check", f"""
WITH {EVALUATIONS}, f AS (SELECT source AS station_id, timestamp_utc, pm25, pm10 FROM hourly),
base AS (SELECT * FROM f ORDER BY timestamp_utc, station_id LIMIT 168),
cur AS (SELECT * FROM f WHERE timestamp_utc >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY),
long AS (SELECT 0 AS side, 'pm25' AS feature, pm25 AS v FROM base UNION ALL SELECT 0, 'pm10', pm10 FROM base UNION ALL SELECT 1, 'pm25', pm25 FROM cur UNION ALL SELECT 1, 'pm10', pm10 FROM cur),
q AS (SELECT feature, count(*) AS nb, list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM long WHERE side = 0 GROUP BY 1),
n AS (SELECT feature, count(*) AS nc FROM long WHERE side = 1 GROUP BY 1),
h AS (SELECT feature, nb, nc, least(greatest(len(list_filter(e, lambda x: v >= x)), 1), len(e) - 1) AS bin, count(*) FILTER (WHERE side = 0) / nb AS b, count(*) FILTER (WHERE side = 1) / nc AS c
  FROM long JOIN q USING (feature) JOIN n USING (feature) GROUP BY 1, 2, 3, 4),
p AS (SELECT feature, sum((greatest(c, 1e-3) - greatest(b, 1e-3)) * ln(greatest(c, 1e-3) / greatest(b, 1e-3))) AS psi FROM h GROUP BY 1),
w AS (SELECT psi, feature FROM p ORDER BY psi DESC, feature LIMIT 1),
r AS (SELECT sqrt(avg(pow(y - p1, 2))) AS cur FROM scored WHERE timestamp_utc >= TIMESTAMP '2024-01-29 12:00:00'),
d AS (SELECT avg(rmse) AS usual FROM (SELECT day, avg(rmse) AS rmse FROM evals GROUP BY 1 ORDER BY day DESC LIMIT 7))
SELECT feature AS worst_feature, {q6('psi')} AS max_psi, {q6('cur')} AS current_rmse, {q6('usual')} AS baseline_rmse, (cur - usual) / usual > 0.15 AS degraded, true AS event_period,
       CAST(0.5 AS DOUBLE) AS effective_threshold, psi > 0.5 OR (cur - usual) / usual > 0.15 AS should_retrain FROM w, r, d""")
def drift_flow(spark, folder):
    """First 168 rows against the last day, error of the last day against the last seven."""
    features = hourly(spark, folder).withColumnRenamed("source", "station_id")
    recent = scored(spark, folder).where(F.col(TS) >= F.lit(ASOF - dt.timedelta(days=1))).withColumn("yhat", F.col("p1"))
    daily = evaluations(spark, folder).groupBy("day").agg(F.avg("rmse").alias("rmse"))
    row = jobs.drift_check(features, recent, daily, asof=ASOF, columns=["pm25", "pm10"])
    return rounded(row.select("worst_feature", "max_psi", "current_rmse", "baseline_rmse", "degraded", "event_period", "effective_threshold", "should_retrain"), "effective_threshold")


@query("flow_train_and_promote")
def train(spark, folder):
    """Both forecasters and their blend on all hourly series, best one against a champion."""
    rows = hourly(spark, folder)
    result = jobs.train_and_blend(rows, "source", ["pm25", "pm10"], fraction=0.5)
    return rounded(jobs.promotion(result.scores, 30.0))


@query("flow_alerts")
def alerts(spark, folder):
    """Forest and fault alerts over all readings, counted by kind."""
    rows = readings(spark, folder).withColumn("pm25", F.when(F.col("pm25") < 10, 0.0).otherwise(F.col("pm25")))
    return jobs.alerts(rows, columns=["pm25", "pm10"], row_id=("event_id",)).groupBy("alert_type").agg(F.count(F.lit(1)).alias("n"))


@query("flow_ward_estimates")
def wards_flow(spark, folder):
    """Ward values of every hour, summarised per ward."""
    rows = jobs.ward_estimates(readings(spark, folder), wards(spark))
    return rounded(rows.groupBy("station_id", "ward_name").agg(F.count("pm25").alias("n"), F.avg("pm25").alias("pm25"), F.max("kriging_variance").alias("max_variance")))


@query("flow_ward_hours", f"""
WITH {READINGS}, h AS (SELECT date_trunc('hour', timestamp_utc) AS hour FROM readings WHERE pm25 IS NOT NULL GROUP BY 1 HAVING count(*) >= 3), {ward_values_sql()}
SELECT 'ward_' || ward_id AS station_id, ward_name, count(*) AS n FROM h, wards GROUP BY 1, 2""")
def ward_hours(spark, folder):
    """Hours estimated per ward."""
    rows = jobs.ward_estimates(readings(spark, folder), wards(spark))
    return rows.groupBy("station_id", "ward_name").agg(F.count("pm25").alias("n"))


@query("flow_features_to_online", f"""
WITH {READINGS}, s AS (SELECT station_id, timestamp_utc, pm25, avg(pm25) OVER (PARTITION BY station_id ORDER BY timestamp_utc RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW) AS m FROM readings)
SELECT 'features:' || station_id || ':latest' AS key, pm25, {q6('m')} AS pm25_24h_mean, hour(timestamp_utc) AS hour_of_day FROM s
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC) = 1""")
def features_online(spark, folder):
    """Features computed, appended, read back and published as the newest row per station."""
    snapshot = jobs.features_to_online(readings(spark, folder), None, default_calendar(spark), work_dir(spark, "feature-table"))
    row = F.from_json("value", "pm25 double, pm25_24h_mean double, hour_of_day long").alias("r")
    return rounded(snapshot.select("key", row).select("key", "r.*"), "pm25")
