"""M: models, explanations and published forecasts."""

from __future__ import annotations

import datetime as dt

import numpy as np

from pyspark.sql import functions as F

from hazeline.operators import forecasts, iforest, lagged, regression
from hazeline.operators.explain import explanation, top_contributors
from hazeline.operators.faults import statistical_alerts
from hazeline.operators.metrics import anomaly_summary, horizon_rmse, regression_metrics
from hazeline.operators.spatial import Variogram, fit_variogram, krige, semivariogram
from hazeline.operators.windows import chronological_split, latest_per_key, sequences, trailing

from .base import HOURLY, READINGS, hourly, q6, query, r6, readings, rounded, ward_values_sql, wards

TS = "timestamp_utc"
ASOF = dt.datetime(2024, 1, 31)


def seasonal_rows(spark, folder):
    """Hourly series with a weather stand-in as regressor."""
    return hourly(spark, folder).withColumn("humidity_pct", F.col("pm10"))


@query("m1_seasonal_regression")
def m1(spark, folder):
    """Shared seasonal model fitted on the first 80 % of each series and scored on the rest."""
    split = chronological_split(seasonal_rows(spark, folder), "source", TS)
    model = forecasts.fit_seasonal(split.where("split = 'train'"), TS)
    scored = forecasts.predict_seasonal(model, split, TS)
    return rounded(regression_metrics(scored, "pm25", "yhat", ["split"]))


@query("m1_seasonal_forecast_by_station")
def m1_station(spark, folder):
    """One seasonal model per station and its next 24 hours."""
    rows = readings(spark, folder).select("station_id", TS, "pm25")
    model = forecasts.fit_seasonal(rows, TS, by="station_id", spec=forecasts.seasonal_spec(rows, TS, hinges=3, seasons=((7.0, 2), (1.0, 2)), regressors=(), ridge=0.05))
    return rounded(forecasts.predict_seasonal(model, forecasts.future_hours(rows, "station_id", TS), TS))


@query("m2_multistep_regression")
def m2(spark, folder):
    """48 hours in, 24 hours out over all series; RMSE per horizon on the training windows."""
    rows = hourly(spark, folder)
    model = forecasts.fit_multistep(rows, "source", TS, ["pm25", "pm10"], "pm25")
    windows = sequences(rows, "source", TS, ["pm25", "pm10"], "pm25")
    predicted = forecasts.predict_multistep(model, windows, ["source", TS, "y"])
    aligned = predicted.withColumn("actual", F.element_at("y", F.col("horizon")))
    return rounded(horizon_rmse(aligned, "horizon", "actual", "forecast"))


@query("m2_huber_forecaster")
def m2_huber(spark, folder):
    """12 hours in, 3 hours out under the Huber loss; RMSE per horizon on the training windows."""
    rows = hourly(spark, folder)
    model = forecasts.fit_multistep(rows, "source", TS, ["pm25", "pm10"], "pm25", 12, 3, loss="huber", delta=10.0, rounds=8)
    windows = sequences(rows, "source", TS, ["pm25", "pm10"], "pm25", 12, 3)
    predicted = forecasts.predict_multistep(model, windows, ["source", TS, "y"])
    return rounded(horizon_rmse(predicted.withColumn("actual", F.element_at("y", F.col("horizon"))), "horizon", "actual", "forecast"))


@query("m2_huber_step", f"""
WITH {READINGS}, w AS (SELECT pm10 AS x, pm25 AS y, 20 / greatest(abs(pm25 - 50), 20) AS w FROM readings),
s AS (SELECT sum(w) AS s, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy, count(*) AS n FROM w)
SELECT n, {q6('(s * sxy - sx * sy) / (s * sxx - sx * sx)')} AS slope,
       {q6('(sy - (s * sxy - sx * sy) / (s * sxx - sx * sx) * sx) / s')} AS intercept FROM s""")
def m2_step(spark, folder):
    """One reweighted step from the constant 50: weights fall beyond a miss of 20."""
    row = regression.weighted_products(readings(spark, folder), F.array("pm10"), F.array("pm25"), 1, np.zeros((1, 1)), np.array([50.0]), 20.0)
    s, sx, sy, sxx, sxy = (F.col("gram")[i] for i in (0, 1, 2, 4, 5))
    slope = (s * sxy - sx * sy) / (s * sxx - sx * sx)
    return rounded(row.select("n", slope.alias("slope"), ((sy - slope * sx) / s).alias("intercept")))


@query("m2_window_products", f"""
WITH {HOURLY}, z AS (
  SELECT source, pm25 AS x3, lag(pm25, 1) OVER w AS x2, lag(pm25, 2) OVER w AS x1, lead(pm25, 1) OVER w AS y1, lead(pm25, 2) OVER w AS y2
  FROM hourly WINDOW w AS (PARTITION BY source ORDER BY timestamp_utc))
SELECT count(*) AS n, round(sum(x1 * x1), 2) AS x1_x1, round(sum(x1 * x3), 2) AS x1_x3, round(sum(x3 * x3), 2) AS x3_x3, round(sum(x2 * y2), 2) AS x2_y2,
       round(sum(y1 * y2), 2) AS y1_y2, round(sum(y2), 2) AS y2 FROM z WHERE x1 IS NOT NULL AND y2 IS NOT NULL""")
def m2_products(spark, folder):
    """Cross-products of all windows of three hours and the two behind them, from lagged products of the rows."""
    blocks = lagged.window_blocks(hourly(spark, folder), "source", TS, ["pm25"], "pm25", 3, 2)
    places = {"x1_x1": (1, 1), "x1_x3": (1, 3), "x3_x3": (3, 3), "x2_y2": (2, 5), "y1_y2": (4, 5), "y2": (0, 5)}
    found = lagged.window_products(blocks, "source", 3, 2)
    return found.select("n", *[F.round(F.col("gram")[6 * i + j], 2).alias(c) for c, (i, j) in places.items()])


def anomaly_inputs(spark, folder):
    spec = {"pm25_1h_mean": ("mean", 1), "pm25_6h_mean": ("mean", 6)}
    return trailing(readings(spark, folder), "station_id", TS, "pm25", spec)


@query("m3_isolation_forest")
def m3(spark, folder):
    """Forest over every reading, alerts for the flagged 5 %."""
    rows = anomaly_inputs(spark, folder)
    forest = iforest.fit_iforest(rows)
    return rounded(statistical_alerts(iforest.score_iforest(rows, forest)))


@query("m3_anomaly_summary")
def m3_summary(spark, folder):
    rows = anomaly_inputs(spark, folder)
    forest = iforest.fit_iforest(rows, trees=50)
    return rounded(anomaly_summary(iforest.score_iforest(rows, forest)))


@query("m4_ward_kriging")
def m4(spark, folder):
    """Every hour's sensors onto all wards with one variogram fitted on the whole history."""
    rows = readings(spark, folder).withColumn("hour", F.date_trunc("hour", TS).cast("timestamp_ntz"))
    variogram = fit_variogram(semivariogram(rows, "hour", "pm25", 0.03, 10))
    return rounded(krige(rows, wards(spark), variogram, "hour").drop("ward_id"), "lat", "lon")


PLACES = f"""{READINGS}, p AS (
  SELECT date_trunc('hour', timestamp_utc) AS hour, lat, lon, avg(pm25) AS z, count(*) AS n FROM readings GROUP BY 1, 2, 3),
h AS (SELECT hour FROM p GROUP BY 1 HAVING sum(n) >= 3)"""


def hourly_places(spark, folder):
    return readings(spark, folder).withColumn("hour", F.date_trunc("hour", TS).cast("timestamp_ntz"))


@query("m4_kriging_at_sensors", f"""
WITH {PLACES} SELECT hour, lat, lon, {q6('z')} AS pm25, CAST(0 AS DOUBLE) AS kriging_variance FROM p JOIN h USING (hour)""")
def m4_exact(spark, folder):
    """Targets at the sensors' places: where a place reported, its own mean with no variance."""
    rows = hourly_places(spark, folder)
    goals = rows.select("lat", "lon").distinct().select(
        (F.round(F.col("lat") * 100) * 10000 + F.round(F.col("lon") * 100)).cast("int").alias("ward_id"), F.lit("place").alias("ward_name"), "lat", "lon")
    found = krige(rows, goals, Variogram("exponential", 100.0, 0.5, 0.0), "hour")
    places = rows.select("hour", "lat", "lon").distinct()
    return rounded(found.join(places, ["hour", "lat", "lon"]).select("hour", "lat", "lon", "pm25", F.abs(r6("kriging_variance")).alias("kriging_variance")), "lat", "lon")


@query("m4_kriging_pure_nugget", f"""
WITH {PLACES}, {ward_values_sql()}, m AS (SELECT hour, avg(z) AS z FROM p JOIN h USING (hour) GROUP BY 1)
SELECT m.hour, ward_name, {q6('coalesce(p.z, m.z)')} AS pm25 FROM m CROSS JOIN wards w
LEFT JOIN p ON p.hour = m.hour AND sqrt(pow(p.lat - w.lat, 2) + pow(p.lon - w.lon, 2)) <= 1e-10""")
def m4_nugget(spark, folder):
    """Without spatial dependence a ward gets the mean of the places, or the value of a sensor right on it."""
    found = krige(hourly_places(spark, folder), wards(spark), Variogram("spherical", 0.0, 0.1, 4.0), "hour", size=10)
    return rounded(found.select("hour", "ward_name", "pm25"))


@query("m3_forest_counts", f"""
WITH {READINGS} SELECT count(*) AS n_rows FROM readings""")
def m3_counts(spark, folder):
    """Every reading is scored once."""
    rows = anomaly_inputs(spark, folder)
    return iforest.score_iforest(rows, iforest.fit_iforest(rows, trees=20)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("m5_forest_additive", f"WITH {READINGS} SELECT count(*) AS n_rows, count(*) AS n_additive FROM readings")
def m5_additive(spark, folder):
    """Contributions of every reading's features add up to its depth in the forest."""
    rows = anomaly_inputs(spark, folder)
    found = iforest.explain_iforest(rows, iforest.fit_iforest(rows, trees=5, subsample=64))
    total = F.col("baseline") + F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["contribution"])
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(total - F.col("depth")) < 1e-6).alias("n_additive"))


@query("m5_anomaly_drivers")
def m5_drivers(spark, folder):
    """What makes each flagged reading anomalous: its features' exact contributions to the mean depth."""
    rows = anomaly_inputs(spark, folder)
    forest = iforest.fit_iforest(rows, trees=50)
    flagged = iforest.score_iforest(rows, forest).where("is_anomaly").drop("anomaly_score", "is_anomaly")
    found = iforest.explain_iforest(flagged, forest)
    return rounded(top_contributors(found, ["event_id"], "parts", 3))


TERMS = ["pm10", "pm25_24h_mean", "humidity_pct", "is_monsoon"]
LINEAR = f"""{READINGS}, x AS (
  SELECT event_id, pm25, pm10, pm25 * 0.5 + pm10 AS pm25_24h_mean, pm10 * pm10 / 100 AS humidity_pct, CASE WHEN source = 'view' THEN 1.0 ELSE 0.0 END AS is_monsoon FROM readings),
m AS (SELECT regr_slope(pm25, pm10) AS b1, avg(pm10) AS a1, regr_slope(pm25, pm25_24h_mean) AS b2, avg(pm25_24h_mean) AS a2,
  regr_slope(pm25, humidity_pct) AS b3, avg(humidity_pct) AS a3, regr_slope(pm25, is_monsoon) AS b4, avg(is_monsoon) AS a4 FROM x),
c AS (SELECT event_id, pm25, unnest(['pm10', 'pm25_24h_mean', 'humidity_pct', 'is_monsoon']) AS feature,
  unnest([b1 * (pm10 - a1), b2 * (pm25_24h_mean - a2), b3 * (humidity_pct - a3), b4 * (is_monsoon - a4)]) AS contribution FROM x, m),
t AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c)"""


def linear_inputs(spark, folder):
    """Four inputs and their (coefficient, mean), the coefficients being slopes of simple regressions."""
    k, v = F.col("pm10"), F.col("pm25")
    x = readings(spark, folder).select("event_id", "pm25", "pm10", (v * 0.5 + k).alias("pm25_24h_mean"), (k * k / 100).alias("humidity_pct"),
                                       F.when(F.col("source") == "view", 1.0).otherwise(0.0).alias("is_monsoon"))
    fit = x.agg(*[F.regr_slope("pm25", c).alias(f"b_{c}") for c in TERMS], *[F.avg(c).alias(f"a_{c}") for c in TERMS]).first()
    return x, {c: (fit[f"b_{c}"], fit[f"a_{c}"]) for c in TERMS}


def with_parts(spark, folder):
    x, terms = linear_inputs(spark, folder)
    return x.select("event_id", "pm25", regression.contribution_array(terms).alias("parts"))


@query("m5_contributions", f"WITH {LINEAR} SELECT event_id, feature, {q6('contribution')} AS contribution FROM c")
def m5(spark, folder):
    x, terms = linear_inputs(spark, folder)
    return rounded(regression.contributions(x, ["event_id"], terms))


@query("a20_feature_importance", f"WITH {LINEAR} SELECT feature, {q6('avg(abs(contribution))')} AS importance FROM c GROUP BY 1")
def a20(spark, folder):
    x, terms = linear_inputs(spark, folder)
    return rounded(regression.importance(regression.contributions(x, ["event_id"], terms)))


@query("t3_top_contributors", f"""
WITH {LINEAR} SELECT event_id, feature, CAST(rank AS INTEGER) AS rank, {q6('contribution')} AS contribution, CASE WHEN contribution > 0 THEN 'increases' ELSE 'decreases' END AS direction FROM t WHERE rank <= 3""")
def t3(spark, folder):
    return rounded(top_contributors(with_parts(spark, folder), ["event_id"], "parts", 3))


@query("t3_explanations", f"""
WITH {LINEAR}, s AS (SELECT event_id, max(pm25) AS p, list(CASE feature WHEN 'pm25_24h_mean' THEN '24-hour rolling average' WHEN 'humidity_pct' THEN 'Humidity level'
    WHEN 'is_monsoon' THEN 'Monsoon season (dust suppression)' ELSE feature END || CASE WHEN contribution > 0 THEN ' increased' ELSE ' decreased' END || ' PM2.5 by ' || printf('%.1f', abs(contribution))
    || ' µg/m³' ORDER BY rank) FILTER (WHERE rank <= 5 AND abs(contribution) >= 0.5) AS parts FROM t GROUP BY 1)
SELECT event_id, CASE WHEN coalesce(len(parts), 0) = 0 THEN 'Current PM2.5 prediction: ' || printf('%.1f', p + 1e-6) || ' µg/m³ (no dominant single factor)'
  ELSE 'Predicted PM2.5: ' || printf('%.1f', p + 1e-6) || ' µg/m³. Key drivers: ' || array_to_string(parts, '; ') || '.' END AS explanation FROM s""")
def t3_text(spark, folder):
    return with_parts(spark, folder).select("event_id", explanation(F.col("parts"), F.col("pm25") + 1e-6).alias("explanation"))


LATEST = f"""{READINGS}, latest AS (SELECT station_id, timestamp_utc, pm25 FROM readings QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY timestamp_utc DESC, event_id DESC) = 1)"""


def latest(spark, folder):
    return latest_per_key(readings(spark, folder).select("station_id", TS, "event_id", "pm25"), "station_id", [TS, "event_id"])


@query("m6_diurnal_forecast", f"""
WITH {LATEST} SELECT station_id, CAST(h AS INTEGER) AS horizon, {q6('''greatest(1, (pm25 + (60 - pm25) * (1 - exp(-0.05 * h)))
  * (1 + 0.3 * sin(2 * pi() * ((hour(timestamp_utc) + 5.75 + h) % 24 - 8) / 24)))''')} AS forecast FROM latest, range(1, 25) t(h)""")
def m6(spark, folder):
    rows = forecasts.diurnal_forecast(latest(spark, folder), "pm25", F.col(TS), 24)
    return rounded(rows.select("station_id", "horizon", "forecast"))


@query("m7_forecast_all_stations", f"""
WITH {LATEST}, v AS (SELECT station_id, timestamp_utc AS t, coalesce(nullif(CASE WHEN pm25 >= 20 THEN pm25 ELSE 0 END, 0), 50.0) AS last FROM latest),
f AS (SELECT station_id, h, t, 1.96 * greatest(last * 0.15, 5) AS half, greatest(1, (last + (60 - last) * (1 - exp(-0.05 * h)))
  * (1 + 0.3 * sin(2 * pi() * ((hour(t) + 5.75 + h) % 24 - 8) / 24))) AS x FROM v, range(1, 73) r(h)),
p AS (SELECT *, greatest(0, least(500, x)) AS c FROM f)
SELECT station_id, CAST(h AS INTEGER) AS horizon, t + INTERVAL 1 HOUR * h AS hour, round(c, 2) AS pm25_predicted, round(greatest(0, x - half), 2) AS confidence_lower,
       round(least(1000, x + half), 2) AS confidence_upper,
       CASE WHEN c <= 12.0 THEN 'Good' WHEN c <= 35.4 THEN 'Moderate' WHEN c <= 55.4 THEN 'USG' WHEN c <= 150.4 THEN 'Unhealthy' WHEN c <= 250.4 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS aqi_category,
       'fallback_diurnal' AS model_used FROM p""")
def m7(spark, folder):
    rows = latest(spark, folder).withColumn("last", F.when(F.col("pm25") >= 20, F.col("pm25")).otherwise(0.0))
    return forecasts.forecast_all(rows, "station_id", "last", F.col(TS), 72)


def trend_model(spark, folder):
    """A straight line per station: the seasonal regression with nothing but its trend."""
    rows = readings(spark, folder).select("event_id", "station_id", TS, "pm25")
    spec = forecasts.seasonal_spec(rows, TS, hinges=0, seasons=(), regressors=(), ridge=0.0)
    return rows, forecasts.fit_seasonal(rows, TS, by="station_id", spec=spec)


LINES = f"""{READINGS}, l AS (
  SELECT station_id, regr_slope(pm25, (epoch(timestamp_utc) - 1704067200)) AS b, regr_intercept(pm25, (epoch(timestamp_utc) - 1704067200)) AS a, avg((epoch(timestamp_utc) - 1704067200)) AS t, avg(pm25) AS y,
         sqrt(greatest(var_pop(pm25) - regr_slope(pm25, (epoch(timestamp_utc) - 1704067200)) * covar_pop(pm25, (epoch(timestamp_utc) - 1704067200)), 0)) AS sd FROM readings GROUP BY 1)"""


@query("m1_trend_by_station", f"WITH {LINES} SELECT event_id, round(y + b * ((epoch(timestamp_utc) - 1704067200) - t) + 1e-8, 4) AS yhat, round(y + b * ((epoch(timestamp_utc) - 1704067200) - t) - 1.2816 * sd + 1e-8, 4) AS yhat_lower FROM readings JOIN l USING (station_id)")
def m1_trend(spark, folder):
    rows, model = trend_model(spark, folder)
    found = forecasts.predict_seasonal(model, rows, TS)
    return found.select("event_id", *[F.round(F.col(c) + 1e-8, 4).alias(c) for c in ("yhat", "yhat_lower")])


@query("m5_model_contributions", f"WITH {LINES} SELECT event_id, round(y + 1e-8, 4) AS baseline, 'trend' AS feature, round(b * ((epoch(timestamp_utc) - 1704067200) - t) + 1e-8, 4) AS contribution FROM readings JOIN l USING (station_id)")
def m5_model(spark, folder):
    """Contributions of fitted station models."""
    rows, model = trend_model(spark, folder)
    found = forecasts.seasonal_contributions(model, rows, TS)
    rows = found.select("event_id", "baseline", F.inline("parts"))
    return rows.select("event_id", "feature", *[F.round(F.col(c) + 1e-8, 4).alias(c) for c in ("baseline", "contribution")])


@query("m7_model_forecasts", f"""
WITH {LINES}, n AS (SELECT station_id, max(timestamp_utc) AS last FROM readings GROUP BY 1),
f AS (SELECT station_id, CAST(h AS INTEGER) AS horizon, y + b * (epoch(last) - 1704067200 + 3600 * h - t) AS v, sd FROM l JOIN n USING (station_id), range(1, 25) r(h))
SELECT station_id, horizon, round(greatest(0, least(500, v)) + 1e-8, 2) AS pm25_predicted, 'seasonal_regression' AS model_used FROM f""")
def m7_model(spark, folder):
    """Published forecasts from station models."""
    from hazeline.plans.jobs import publish_model_forecasts

    rows, model = trend_model(spark, folder)
    return publish_model_forecasts(rows, model).select("station_id", "horizon", "pm25_predicted", "model_used")
