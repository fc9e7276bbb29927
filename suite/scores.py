"""A: aggregates, validation, drift and selection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hazeline.constants import LATENCY_BUCKETS
from hazeline.operators import drift, metrics, quality, servicelog
from hazeline.operators.forecasts import diurnal_forecast
from hazeline.operators.windows import chronological_split, latest_per_key, rolling_rows_mean, row_lags

from .base import HOURLY, READINGS, SCORED, events, hourly, q6, query, readings, rounded, scored, wards
from .inputs import WARD_LATEST, ward_latest
from hazeline.operators.spatial import ward_values

TS = "timestamp_utc"


def metric_sql(y: str, p: str) -> str:
    e = f"({y} - {p})"
    return f"""{q6(f'sqrt(avg(pow{e[:-1]}, 2)))')} AS rmse, {q6(f'avg(abs{e})')} AS mae,
       {q6(f'avg(abs({e} / greatest(abs({y}), 1e-8))) * 100')} AS mape,
       {q6(f'CASE WHEN var_pop({y}) > 0 THEN 1 - sum(pow{e[:-1]}, 2)) / (count(*) * var_pop({y})) ELSE 0 END')} AS r2, count(*) AS n"""


@query("a1_regression_metrics", f"WITH {SCORED}, s AS (SELECT source, y, CASE WHEN p2 < 90 THEN p1 END AS p FROM scored) SELECT source, {metric_sql('y', 'p')} FROM s WHERE p IS NOT NULL GROUP BY 1")
def a1(spark, folder):
    rows = scored(spark, folder).withColumn("p", F.when(F.col("p2") < 90, F.col("p1")))
    return rounded(metrics.regression_metrics(rows, "y", "p", ["source"]))


@query("a2_horizon_rmse", f"WITH {SCORED} SELECT CAST(horizon AS INTEGER) AS horizon, {q6('sqrt(avg(pow(y - p1, 2)))')} AS rmse FROM scored GROUP BY 1")
def a2(spark, folder):
    return rounded(metrics.horizon_rmse(scored(spark, folder), "horizon", "y", "p1"))


@query("a2_horizon_rmse_wide", f"WITH {SCORED} SELECT source, {', '.join(q6(f'sqrt(avg(pow(y - p1, 2)) FILTER (WHERE horizon = {h}))') + f' AS rmse_h{h}' for h in range(1, 25))} FROM scored GROUP BY 1")
def a2_wide(spark, folder):
    return rounded(metrics.horizon_rmse(scored(spark, folder), "horizon", "y", "p1", ["source"], wide=True))


@query("a3_anomaly_summary", f"""
WITH {READINGS} SELECT source, count(*) AS n, count(*) FILTER (WHERE pm25 > 150) AS n_anomalies,
  {q6('count(*) FILTER (WHERE pm25 > 150) / count(*)')} AS anomaly_rate, {q6('avg(0.75 - pm25 / 200)')} AS mean_score FROM readings GROUP BY 1""")
def a3(spark, folder):
    rows = readings(spark, folder).withColumns({"anomaly_score": 0.75 - F.col("pm25") / 200, "is_anomaly": F.col("pm25") > 150})
    return rounded(metrics.anomaly_summary(rows, by=["source"]))


HALF = dt.datetime(2024, 1, 16)


def drift_sides(spark, folder):
    """First and second half of the month; one shifted, one binary, one constant and one empty column."""
    rows = readings(spark, folder).select(
        TS, "pm25", "pm10", (F.col("pm25") + F.when(F.col(TS) >= F.lit(HALF), 15.0).otherwise(0.0)).alias("shifted"),
        F.when(F.col("source") == "view", 1.0).otherwise(0.0).alias("flag"), F.lit(7.0).alias("constant"),
        F.when(F.col(TS) >= F.lit(HALF), F.col("pm10")).alias("absent"))
    return rows.where(F.col(TS) < F.lit(HALF)), rows.where(F.col(TS) >= F.lit(HALF))


DRIFT_COLUMNS = ["pm25", "pm10", "shifted", "flag", "constant", "absent"]
PSI = f"""
long AS (
  UNPIVOT (SELECT CASE WHEN timestamp_utc < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS side, pm25, pm10,
      pm25 + CASE WHEN timestamp_utc >= TIMESTAMP '2024-01-16' THEN 15 ELSE 0 END AS shifted,
      CASE WHEN source = 'view' THEN 1.0::DOUBLE ELSE 0 END AS flag, 7.0::DOUBLE AS constant,
      CASE WHEN timestamp_utc >= TIMESTAMP '2024-01-16' THEN pm10 END AS absent FROM readings)
  ON pm25, pm10, shifted, flag, constant, absent INTO NAME feature VALUE value),
b AS (SELECT feature, count(DISTINCT value) AS nd, quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q, count(*) AS nb FROM long WHERE side = 0 GROUP BY 1),
c AS (SELECT feature, count(*) FILTER (WHERE side = 1) AS nc, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
e AS (SELECT feature, nb, nc, CASE WHEN nd > 2 THEN list_sort(list_distinct(q)) ELSE list_transform(range(11), lambda i: lo + (hi - lo) * i / 10) END AS edges FROM b JOIN c USING (feature)),
h AS (
  SELECT feature, nb, nc, least(greatest(len(list_filter(edges, lambda x: value >= x)), 1), len(edges) - 1) AS bin,
         count(*) FILTER (WHERE side = 0) AS x, count(*) FILTER (WHERE side = 1) AS y
  FROM long JOIN e USING (feature) GROUP BY 1, 2, 3, 4),
p AS (SELECT feature, greatest(x / nb, 1e-3) AS pb, greatest(y / nc, 1e-3) AS pc FROM h),
psi AS (
  SELECT f.feature, coalesce(sum((pc - pb) * ln(pc / pb)), 0) AS psi
  FROM (VALUES ('pm25'), ('pm10'), ('shifted'), ('flag'), ('constant'), ('absent')) f(feature) LEFT JOIN p USING (feature) GROUP BY 1)"""


@query("a4_psi", f"WITH {READINGS}, {PSI} SELECT feature, {q6('psi')} AS psi FROM psi")
def a4(spark, folder):
    return rounded(drift.psi(*drift_sides(spark, folder), DRIFT_COLUMNS))


@query("a5_worst_feature", f"WITH {READINGS}, {PSI} SELECT {q6('psi')} AS max_psi, feature AS worst_feature FROM psi ORDER BY psi DESC, feature LIMIT 1")
def a5(spark, folder):
    return rounded(drift.worst_feature(drift.psi(*drift_sides(spark, folder), DRIFT_COLUMNS)))


def dirty(spark, folder):
    """Readings with gaps, out-of-range values, a bad source and long ids."""
    v, k = F.col("pm25"), F.col("pm10")
    return readings(spark, folder).select(
        "event_id", F.when(k == 1, None).when(k == 2, F.lit("")).when(k == 3, F.repeat("station_id", 30)).otherwise(F.col("station_id")).alias("station_id"),
        F.when(F.col("source") == "view", "openaq").when(F.col("source") == "error", "unknown_feed").otherwise("aqicn").alias("source"),
        F.when(k == 4, 10.0).otherwise(F.col("lat")).alias("lat"), F.when(k == 5, None).otherwise(F.col("lon")).alias("lon"),
        F.when(k != 6, F.col(TS)).alias(TS), F.when(v < 10, None).when(v > 200, v + 900).otherwise(v).alias("pm25"),
        F.when(v < 60, None).otherwise(k - 3).alias("pm10"), (v * 2).alias("no2"), F.lit(None).cast("double").alias("o3"), (v / 4).alias("co"),
        (v * 2).cast("int").alias("aqi_us"))


DIRTY = f"""{READINGS}, dirty AS (
  SELECT event_id, CASE WHEN pm10 = 1 THEN NULL WHEN pm10 = 2 THEN '' WHEN pm10 = 3 THEN repeat(station_id, 30) ELSE station_id END AS station_id,
         CASE source WHEN 'view' THEN 'openaq' WHEN 'error' THEN 'unknown_feed' ELSE 'aqicn' END AS source,
         CASE WHEN pm10 = 4 THEN 10 ELSE lat END AS lat, CASE WHEN pm10 <> 5 THEN lon END AS lon, CASE WHEN pm10 <> 6 THEN timestamp_utc END AS timestamp_utc,
         CASE WHEN pm25 < 10 THEN NULL WHEN pm25 > 200 THEN pm25 + 900 ELSE pm25 END AS pm25, CASE WHEN pm25 >= 60 THEN pm10 - 3 END AS pm10,
         pm25 * 2 AS no2, CAST(NULL AS DOUBLE) AS o3, pm25 / 4 AS co, CAST(trunc(pm25 * 2) AS INTEGER) AS aqi_us FROM readings)"""


@query("a6_reading_gates", f"WITH {DIRTY} SELECT {q6('count(*) FILTER (WHERE pm25 IS NOT NULL OR pm10 IS NOT NULL) / count(*)')} AS present_share, present_share > 0.5 AS present_ok FROM dirty")
def a6(spark, folder):
    return rounded(quality.reading_gates(dirty(spark, folder)))


@query("a6_training_gates", f"""
WITH {HOURLY}, l AS (SELECT CASE WHEN pm10 > 45 THEN pm25 END AS m, lag(pm25) OVER (PARTITION BY source ORDER BY timestamp_utc) AS p FROM hourly)
SELECT count(*) AS n_rows, {q6('least(count(m) / count(*), count(p) / count(*))')} AS lowest_share, lowest_share > 0.7 AS share_ok,
       {q6('stddev_samp(p)')} AS deviation, stddev_samp(p) > 0.01 AS moving_ok FROM l""")
def a6_training(spark, folder):
    rows = row_lags(hourly(spark, folder), "source", TS, "pm25", [1])
    rows = rows.withColumn("pm25_24h_mean", F.when(F.col("pm10") > 45, F.col("pm25")))
    return rounded(quality.training_gates(rows))


A7_RULES = [
    ("station_id", "not_null", "station_id IS NULL"), ("source", "not_null", "source IS NULL"), ("lat", "not_null", "lat IS NULL"),
    ("lon", "not_null", "lon IS NULL"), ("timestamp_utc", "not_null", "timestamp_utc IS NULL"),
    ("station_id", "str_length", "length(station_id) NOT BETWEEN 1 AND 100"),
    ("source", "isin", "source NOT IN ('openaq', 'aqicn', 'kriging_interpolated', 'integration_test')"),
    ("pm25", "in_range", "pm25 NOT BETWEEN 0 AND 999.9"), ("pm10", "in_range", "pm10 NOT BETWEEN 0 AND 2000"),
    ("no2", "in_range", "no2 NOT BETWEEN 0 AND 500"), ("o3", "in_range", "o3 NOT BETWEEN 0 AND 600"), ("co", "in_range", "co NOT BETWEEN 0 AND 100"),
    ("aqi_us", "in_range", "aqi_us NOT BETWEEN 0 AND 500"), ("lat", "in_range", "lat NOT BETWEEN 20 AND 35"), ("lon", "in_range", "lon NOT BETWEEN 80 AND 90"),
]


@query("a7_failure_counts", f"WITH {DIRTY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{k}' AS "check", count(*) FILTER (WHERE {w}) AS n_failures FROM dirty""" for c, k, w in A7_RULES))
def a7(spark, folder):
    return quality.failure_counts(dirty(spark, folder), quality.READING_RULES)


@query("a7_failures", f"WITH {DIRTY} " + " UNION ALL ".join(
    f"""SELECT event_id, '{c}' AS "column", '{k}' AS "check" FROM dirty WHERE {w}""" for c, k, w in A7_RULES))
def a7_long(spark, folder):
    return quality.failures(dirty(spark, folder), quality.READING_RULES, ["event_id"]).drop("value")


@query("a7_quarantine", f"WITH {DIRTY} SELECT event_id, NOT coalesce(" + " OR ".join(f"coalesce({w}, false)" for _, _, w in A7_RULES) + ", false) AS valid FROM dirty")
def a7_split(spark, folder):
    valid, held = quality.validate(dirty(spark, folder), quality.READING_RULES)
    return valid.select("event_id", F.lit(True).alias("valid")).unionByName(held.select("event_id", F.lit(False).alias("valid")))


TRAINING_SQL = [
    ("station_id", "not_null", "station_id IS NULL"), ("timestamp_utc", "not_null", "timestamp_utc IS NULL"),
    ("pm25_24h_mean", "in_range", "pm25_24h_mean NOT BETWEEN 0 AND 999.9"), ("pm25_lag_1h", "in_range", "pm25_lag_1h NOT BETWEEN 0 AND 999.9"),
    ("temp_c", "in_range", "temp_c NOT BETWEEN -20 AND 50"), ("humidity_pct", "in_range", "humidity_pct NOT BETWEEN 0 AND 100"),
]


@query("a7_training_rules", f"""
WITH {READINGS}, t AS (
  SELECT CASE WHEN pm10 > 2 THEN station_id END AS station_id, CASE WHEN pm10 > 5 THEN timestamp_utc END AS timestamp_utc, pm25 * 4 AS pm25_24h_mean,
         pm25 - 20 AS pm25_lag_1h, pm25 - 40 AS temp_c, pm10 * 1.1 AS humidity_pct FROM readings)
""" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", '{k}' AS "check", count(*) FILTER (WHERE {w}) AS n_failures FROM t""" for c, k, w in TRAINING_SQL))
def a7_training(spark, folder):
    v, k = F.col("pm25"), F.col("pm10")
    rows = readings(spark, folder).select(
        F.when(k > 2, F.col("station_id")).alias("station_id"), F.when(k > 5, F.col("timestamp_utc")).alias("timestamp_utc"), (v * 4).alias("pm25_24h_mean"),
        (v - 20).alias("pm25_lag_1h"), (v - 40).alias("temp_c"), (k * 1.1).alias("humidity_pct"))
    return quality.failure_counts(rows, quality.TRAINING_RULES)


@query("a7_weather_rules", f"""
WITH {READINGS}, w AS (SELECT pm25 - 15 AS temp_c, pm10 * 1.2 AS humidity_pct, pm25 AS wind_speed_kmh, pm10 * 4 AS wind_dir_deg, pm25 * 2 AS precip_mm, 600 + pm10 * 6 AS pressure_hpa FROM readings)
SELECT c AS "column", 'in_range' AS "check", n AS n_failures FROM (
  SELECT unnest(['temp_c', 'humidity_pct', 'wind_speed_kmh', 'wind_dir_deg', 'precip_mm', 'pressure_hpa']) AS c, unnest([
    count(*) FILTER (WHERE temp_c NOT BETWEEN -20 AND 50), count(*) FILTER (WHERE humidity_pct NOT BETWEEN 0 AND 100), count(*) FILTER (WHERE wind_speed_kmh NOT BETWEEN 0 AND 200),
    count(*) FILTER (WHERE wind_dir_deg NOT BETWEEN 0 AND 360), count(*) FILTER (WHERE precip_mm NOT BETWEEN 0 AND 500), count(*) FILTER (WHERE pressure_hpa NOT BETWEEN 700 AND 1100)]) AS n FROM w)
WHERE n > 0""")
def a7_weather(spark, folder):
    v, k = F.col("pm25"), F.col("pm10")
    w = readings(spark, folder).select("lat", "lon", TS, (v - 15).alias("temp_c"), (k * 1.2).alias("humidity_pct"), v.alias("wind_speed_kmh"),
                                       (k * 4).alias("wind_dir_deg"), (v * 2).alias("precip_mm"), (600 + k * 6).alias("pressure_hpa"))
    return quality.failure_counts(w, quality.WEATHER_RULES).where("n_failures > 0")


@query("a8_optimize_weights", f"""
WITH {SCORED}, g AS (SELECT i / 20 AS w FROM range(21) t(i)),
s AS (SELECT source, w, sqrt(avg(pow(y - (w * p1 + (1 - w) * p2), 2))) AS rmse FROM scored, g GROUP BY 1, 2)
SELECT source, {q6('w')} AS weight_a, {q6('1 - w')} AS weight_b, {q6('rmse')} AS rmse FROM s QUALIFY row_number() OVER (PARTITION BY source ORDER BY rmse, w) = 1""")
def a8(spark, folder):
    return rounded(metrics.optimize_weights(scored(spark, folder), "p1", "p2", "y", ["source"]))


def evaluations(spark, folder):
    """One RMSE per source and day."""
    s = scored(spark, folder).withColumn("day", F.to_date(TS))
    return s.groupBy("source", "day").agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("p1"), 2))).alias("rmse"))


EVALUATIONS = f"""{SCORED}, evals AS (SELECT source, CAST(timestamp_utc AS DATE) AS day, sqrt(avg(pow(y - p1, 2))) AS rmse FROM scored GROUP BY 1, 2)"""


@query("a9_rolling_baseline", f"""
WITH {EVALUATIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS b FROM evals)
SELECT source, {q6('avg(rmse)')} AS baseline FROM r WHERE b <= 7 GROUP BY 1""")
def a9(spark, folder):
    return rounded(metrics.rolling_baseline(evaluations(spark, folder), ["source"], "day", "rmse"))


@query("a9_rolling_baseline_series", f"""
WITH {EVALUATIONS} SELECT source, day, {q6('avg(rmse) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS baseline FROM evals""")
def a9_series(spark, folder):
    rows = rolling_rows_mean(evaluations(spark, folder), "source", "day", "rmse", 7, "baseline")
    return rounded(rows.select("source", "day", "baseline"))


@query("a10_degradation", f"""
WITH {EVALUATIONS}, b AS (SELECT source, day, rmse, avg(rmse) OVER (PARTITION BY source ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS base FROM evals),
d AS (SELECT *, (rmse - base) / nullif(base, 0) AS c FROM b)
SELECT source, day, {q6('c * 100')} AS degradation_pct, coalesce(c > 0.15, false) AS degraded,
       CASE WHEN c > 0.15 THEN 'Model degraded by ' || printf('%.1f', c * 100) || '% (threshold: 15.0%). Triggering retraining.'
            WHEN c IS NOT NULL THEN 'Model performance within bounds: ' || printf('%.1f', c * 100) || '% degradation (threshold: 15.0%)'
            ELSE 'No valid baseline' END AS reason FROM d""")
def a10(spark, folder):
    from hazeline.operators.chunks import over_rows

    rows = over_rows(evaluations(spark, folder), "source", "day", lambda w: {"base": F.avg("rmse").over(w.rowsBetween(-7, -1))}, before=7)
    parts = metrics.degradation(F.col("rmse"), F.col("base"))
    return rounded(rows.select("source", "day", *[c.alias(n) for n, c in parts.items()]))


@query("a11_model_selection", f"""
WITH {EVALUATIONS}, best AS (SELECT source, min(rmse) AS rmse, arg_min(day, rmse) AS run FROM evals WHERE day >= DATE '2024-01-16' GROUP BY 1),
champ AS (SELECT source, arg_max(rmse, day) AS rmse FROM evals WHERE day < DATE '2024-01-16' AND source <> 'view' GROUP BY 1)
SELECT b.source, b.run, {q6('b.rmse')} AS challenger, {q6('c.rmse')} AS champion, {q6('(c.rmse - b.rmse) / c.rmse * 100')} AS improvement_pct,
       coalesce(b.rmse < c.rmse, false) AS should_promote, c.rmse IS NULL OR b.rmse < c.rmse AS promoted,
       CASE WHEN c.rmse IS NULL THEN 'Missing metrics' ELSE 'Challenger RMSE (' || printf('%.2f', b.rmse) || ') is ' || CASE WHEN b.rmse < c.rmse THEN 'better' ELSE 'worse' END
         || ' than champion (' || printf('%.2f', c.rmse) || '). ' || CASE WHEN b.rmse < c.rmse THEN 'Promoting.' ELSE 'Keeping current champion.' END END AS reason
FROM best b LEFT JOIN champ c USING (source)""")
def a11(spark, folder):
    runs = evaluations(spark, folder)
    cut = F.lit(dt.date(2024, 1, 16))
    best = metrics.select_best(runs.where(F.col("day") >= cut), "rmse", "day", ["source"])
    champ = latest_per_key(runs.where((F.col("day") < cut) & (F.col("source") != "view")), "source", ["day"]).select("source", F.col("rmse").alias("champion"))
    rows = best.join(champ, "source", "left")
    new, old = F.col("rmse"), F.col("champion")
    return rounded(rows.select("source", F.col("day").alias("run"), new.alias("challenger"), "champion",
                               *[c.alias(n) for n, c in metrics.compare(old, new).items()], metrics.promote(old, new).alias("promoted")))


DAILY_FORECAST = f"{READINGS}, f AS (SELECT station_id, CASE WHEN pm10 <> 50 THEN pm25 + (pm10 - 20) / 10 END AS v, pm25 AS last FROM readings)"


@query("a12_forecast_sanity", f"""
WITH {DAILY_FORECAST}, r AS (SELECT station_id, count(*) FILTER (WHERE v IS NULL) AS n_null, count(*) FILTER (WHERE v < 0) AS n_negative, count(*) FILTER (WHERE v > 500) AS n_over,
  count(*) FILTER (WHERE v < 20 OR v > 350) AS n_unusual, stddev_pop(v) AS std FROM f GROUP BY 1)
SELECT station_id, n_null, n_negative, n_over, n_unusual, {q6('std')} AS std, CASE WHEN n_null + n_negative + n_over > 0 OR std < 1 THEN 'FAIL' WHEN n_unusual > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM r""")
def a12(spark, folder):
    v = F.when(F.col("pm10") != 50, F.col("pm25") + (F.col("pm10") - 20) / 10)
    return rounded(metrics.forecast_sanity(readings(spark, folder).withColumn("v", v), ["station_id"], "v"))


@query("a12_structure_check", f"""
WITH {SCORED}, r AS (SELECT source, CAST(timestamp_utc AS DATE) AS day, stddev_pop(p2) AS std, sqrt(avg(pow(p2 - p1, 2))) AS rmse_from_last FROM scored GROUP BY 1, 2)
SELECT source, day, {q6('std')} AS std, {q6('rmse_from_last')} AS rmse_from_last, CASE WHEN std < 2 THEN 'FAIL' WHEN rmse_from_last < 1 THEN 'WARN' ELSE 'PASS' END AS status FROM r""")
def a12_structure(spark, folder):
    rows = scored(spark, folder).withColumn("day", F.to_date(TS))
    return rounded(metrics.structure_check(rows, ["source", "day"], "p2", "p1"))


c1 = "CASE WHEN stddev_pop(y) * stddev_pop(p2) > 0 THEN corr(y, p2) END"
c2 = "CASE WHEN stddev_pop(CASE WHEN nx IS NOT NULL THEN p2 END) * stddev_pop(nx) > 0 THEN corr(p2, nx) END"


@query("a13_forecast_diagnostics", f"""
WITH {SCORED}, s AS (SELECT *, CAST(timestamp_utc AS DATE) AS day, lead(p2) OVER (PARTITION BY source, CAST(timestamp_utc AS DATE) ORDER BY timestamp_utc) AS nx FROM scored)
SELECT source, day, {q6('stddev_pop(p2)')} AS std, {q6('max(p2) - min(p2)')} AS range, {q6(c1)} AS corr_actual, {q6(c2)} AS autocorr_1,
       coalesce({c2} > 0.99, false) AS suspicious FROM s GROUP BY 1, 2""")
def a13(spark, folder):
    rows = scored(spark, folder).withColumn("day", F.to_date(TS))
    return rounded(metrics.forecast_diagnostics(rows, ["source", "day"], TS, "y", "p2"))


@query("a14_ward_coverage", f"""
WITH {WARD_LATEST}, r AS (SELECT count(DISTINCT ward_id) AS n_wards, count(*) FILTER (WHERE NOT coalesce(pm25 BETWEEN 0 AND 500, false)) AS n_invalid,
  count(*) FILTER (WHERE NOT (lat BETWEEN 27.6 AND 27.8 AND lon BETWEEN 85.2 AND 85.45)) AS n_outside, stddev_pop(CASE WHEN pm25 BETWEEN 0 AND 500 THEN pm25 END) AS std FROM ward_vals)
SELECT n_wards, n_invalid, n_outside, {q6('std')} AS std, CASE WHEN n_wards < 32 OR n_invalid > 0 OR std < 0.01 THEN 'FAIL' WHEN n_outside > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM r""")
def a14(spark, folder):
    return rounded(metrics.ward_coverage(ward_values(wards(spark), ward_latest(spark, folder))))


@query("a15_blend_consistency", f"""
WITH {SCORED}, r AS (SELECT source, avg(abs((0.42 * p1 + 0.58 * p2) - (0.4 * p1 + 0.6 * p2))) AS e FROM scored GROUP BY 1)
SELECT source, {q6('e')} AS consistency_error, CASE WHEN e < 1 THEN 'PASS' WHEN e < 5 THEN 'WARN' ELSE 'FAIL' END AS status FROM r""")
def a15(spark, folder):
    rows = scored(spark, folder).withColumn("published", 0.42 * F.col("p1") + 0.58 * F.col("p2"))
    return rounded(metrics.blend_consistency(rows, "p1", "p2", "published", ["source"]))


@query("a16_profile", f"""
WITH {READINGS}, h AS (
  SELECT CASE WHEN timestamp_utc < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END AS split, pm25, nullif(pm10, 50) AS pm10, lat FROM readings),
l AS (FROM h UNPIVOT INCLUDE NULLS (v FOR feature IN (pm25, pm10, lat)))
SELECT split, feature, count(*) AS n, count(*) - count(v) AS n_missing, {q6('avg(v)')} AS mean, {q6('stddev_samp(v)')} AS std, {q6('min(v)')} AS min, {q6('max(v)')} AS max,
       {q6('quantile_cont(v, 0.25)')} AS q25, {q6('quantile_cont(v, 0.5)')} AS q50, {q6('quantile_cont(v, 0.75)')} AS q75 FROM l GROUP BY 1, 2""")
def a16(spark, folder):
    rows = readings(spark, folder).select(
        F.when(F.col(TS) < F.lit(HALF), "reference").otherwise("current").alias("split"), "pm25", F.nullif("pm10", F.lit(50.0)).alias("pm10"), "lat")
    return rounded(drift.profile(rows, ["pm25", "pm10", "lat"], "split"))


@query("a16_first_last_profile", f"""
WITH {READINGS}, h AS (
  SELECT * FROM (SELECT 'reference' AS split, pm25, pm10 FROM readings ORDER BY timestamp_utc, event_id LIMIT 168) UNION ALL
  SELECT * FROM (SELECT 'current' AS split, pm25, pm10 FROM readings ORDER BY timestamp_utc DESC, event_id DESC LIMIT 168)),
l AS (FROM h UNPIVOT INCLUDE NULLS (v FOR feature IN (pm25, pm10)))
SELECT split, feature, count(*) AS n, count(*) - count(v) AS n_missing, {q6('avg(v)')} AS mean, {q6('stddev_samp(v)')} AS std, {q6('min(v)')} AS min, {q6('max(v)')} AS max,
       {q6('quantile_cont(v, 0.25)')} AS q25, {q6('quantile_cont(v, 0.5)')} AS q50, {q6('quantile_cont(v, 0.75)')} AS q75 FROM l GROUP BY 1, 2""")
def a16_first_last(spark, folder):
    rows = drift.first_last_split(readings(spark, folder).select("event_id", TS, "pm25", "pm10"), [TS, "event_id"])
    return rounded(drift.profile(rows, ["pm25", "pm10"], "split"))


@query("a17_request_rate", """
WITH m AS (SELECT event_type AS model, date_trunc('minute', ts) - INTERVAL 1 MINUTE * i AS window_start FROM events, range(5) t(i))
SELECT model, window_start, count(*) * 60 / 300 AS per_minute FROM m GROUP BY 1, 2""")
def a17_rate(spark, folder):
    log = events(spark, folder).select(F.col("event_type").alias("model"), "ts")
    return servicelog.sliding_rate(log, "ts", ["model"])


@query("a17_error_counts", "SELECT user_id AS endpoint, event_type AS error_type, count(*) AS n_errors FROM events WHERE event_type = 'error' GROUP BY 1, 2")
def a17_errors(spark, folder):
    log = events(spark, folder).select(F.col("user_id").alias("endpoint"), F.col("event_type").alias("error_type"))
    return servicelog.error_counts(log, F.col("error_type") == "error", ["endpoint", "error_type"])


HISTOGRAM = f"""limits AS (SELECT unnest([{', '.join(f'CAST({b} AS DOUBLE)' for b in LATENCY_BUCKETS)}, NULL]) AS le),
hist AS (SELECT event_type AS model, le, count(*) FILTER (WHERE le IS NULL OR value / 100 <= le) AS cumulative FROM events, limits GROUP BY 1, 2)"""


@query("a17_latency_histogram", f"WITH {HISTOGRAM} SELECT * FROM hist")
def a17_histogram(spark, folder):
    log = events(spark, folder).select(F.col("event_type").alias("model"), (F.col("value") / 100).alias("latency"))
    return servicelog.latency_histogram(log, "latency", ["model"])


@query("a17_latency_p95", f"""
WITH {HISTOGRAM}, r AS (SELECT *, coalesce(lag(cumulative) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low, max(cumulative) OVER (PARTITION BY model) * 0.95 AS rank
  FROM hist WINDOW w AS (PARTITION BY model ORDER BY le NULLS LAST))
SELECT model, {q6('CASE WHEN le IS NULL THEN low ELSE low + (le - low) * (rank - below) / (cumulative - below) END')} AS quantile FROM r WHERE cumulative >= rank AND below < rank""")
def a17_p95(spark, folder):
    log = events(spark, folder).select(F.col("event_type").alias("model"), (F.col("value") / 100).alias("latency"))
    return rounded(servicelog.bucket_quantile(servicelog.latency_histogram(log, "latency", ["model"]), ["model"]))


@query("a18_set_descriptor", f"""
WITH {READINGS}, s AS (SELECT timestamp_utc, CASE WHEN row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc, event_id) <= floor(count(*) OVER (PARTITION BY station_id) * 0.8) THEN 'train' ELSE 'valid' END AS split FROM readings)
SELECT split, min(timestamp_utc) AS first_ts, max(timestamp_utc) AS last_ts, count(*) AS n_rows FROM s GROUP BY 1""")
def a18(spark, folder):
    return metrics.set_descriptor(chronological_split(readings(spark, folder), "station_id", TS, ties=["event_id"]), ["split"], TS)


@query("a19_standardize", f"""
WITH {READINGS}, s AS (SELECT avg(pm25) AS m1, stddev_pop(pm25) AS s1, avg(pm10) AS m2, stddev_pop(pm10) AS s2 FROM readings WHERE timestamp_utc < TIMESTAMP '2024-01-16')
SELECT event_id, {q6('(pm25 - m1) / s1')} AS pm25, {q6('(pm10 - m2) / s2')} AS pm10, CAST(0 AS DOUBLE) AS constant FROM readings, s""")
def a19(spark, folder):
    rows = readings(spark, folder).select("event_id", TS, "pm25", "pm10", F.lit(3.0).alias("constant"))
    return rounded(metrics.standardize(rows, ["pm25", "pm10", "constant"], F.col(TS) < F.lit(HALF)).drop(TS))


@query("a21_forecast_summary", f"""
WITH {READINGS}, l AS (SELECT station_id, pm25 FROM readings QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC, event_id DESC) = 1),
f AS (SELECT station_id, h, greatest(1, (pm25 + (60 - pm25) * (1 - exp(-0.05 * h))) * (1 + 0.3 * sin(2 * pi() * ((0 + 5.75 + h) % 24 - 8) / 24))) AS v FROM l, range(1, 37) t(h))
SELECT station_id, {q6('arg_min(v, h)')} AS current, {q6('max(v) FILTER (WHERE h <= 24)')} AS max_24h, 'fallback_diurnal' AS model FROM f GROUP BY 1""")
def a21(spark, folder):
    latest = latest_per_key(readings(spark, folder).select("station_id", TS, "event_id", "pm25"), "station_id", [TS, "event_id"])
    points = diurnal_forecast(latest, "pm25", F.lit(dt.datetime(2024, 1, 31)), 36).withColumn("model", F.lit("fallback_diurnal"))
    return rounded(metrics.forecast_summary(points, "station_id", "horizon", "forecast", "model"))
