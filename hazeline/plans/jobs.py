"""The hourly, daily and weekly jobs as plans over stored tables.

Each job takes frames and returns frames; where to store them is the caller's
choice (``sources.tables.append``, ``upsert`` and ``export``, ``sources.messages.publish``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..constants import ANOMALY_FEATURES, DRIFT_COLUMNS, HAZARD_PM25, RMSE_DEGRADATION
from ..functions.seasons import in_event_period
from ..functions.text import drift_message, hazard_message
from ..operators.drift import psi, retrain_decision, worst_feature
from ..operators.faults import sensor_faults, statistical_alerts
from ..operators.forecasts import (
    SeasonalModel, SeasonalSpec, fit_multistep, fit_seasonal, forecast_all, predict_multistep, predict_seasonal, served_forecasts,
)
from ..operators.iforest import Forest, fit_iforest, score_iforest
from ..operators.metrics import align, compare, degradation, optimize_weights, promote, regression_metrics, rolling_baseline
from ..operators.quality import READING_RULES, validate
from ..operators.spatial import Variogram, fit_variogram, krige, semivariogram
from ..operators.windows import chronological_split, first_n, latest_per_key, sequences
from ..session import stored
from ..sources.feeds import primary_else_fallback, union_sources
from ..schemas import FEATURES
from ..sources.messages import online_snapshot
from ..sources.tables import history, read_day_table, sensor_rows, upsert
from .features import compute_features

TS = "timestamp_utc"


def ingest_readings(sensor: DataFrame, city: DataFrame, city_fallback: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) readings of all sources; fallback documents count only where the primary has none that day."""
    day = lambda df: df.withColumn("_day", F.to_date(TS))
    if city_fallback is not None:
        city = primary_else_fallback(day(city), day(city_fallback), ["_day"]).drop("_day")
    return validate(union_sources(sensor, city), READING_RULES)


def alerts(readings: DataFrame, forest: Forest | None = None, columns: Sequence[str] = ANOMALY_FEATURES, row_id=("station_id", TS)) -> DataFrame:
    """Statistical anomalies and sensor faults; without a stored forest one is trained on the rows at hand."""
    forest = forest or fit_iforest(readings, columns, row_id)
    return union_sources(statistical_alerts(score_iforest(readings, forest)), sensor_faults(readings))


def ward_estimates(readings: DataFrame, wards: DataFrame, variogram: Variogram | None = None, model: str = "spherical") -> DataFrame:
    """Ward values for every hour of measured readings; the variogram comes from the same history unless given."""
    measured = sensor_rows(readings).withColumn("hour", F.date_trunc("hour", TS).cast("timestamp_ntz"))
    if variogram is None:
        variogram = fit_variogram(semivariogram(measured, "hour", "pm25", 0.02, 12), model)
    return krige(measured, wards, variogram, "hour").withColumnRenamed("hour", TS)


def drift_check(features: DataFrame, predictions: DataFrame, evaluations: DataFrame, *, asof, columns=DRIFT_COLUMNS, baseline_rows: int = 168) -> DataFrame:
    """One decision row: feature drift of the last day against the first rows, error growth, relaxed in event periods.

    ``predictions`` has y and yhat of the last day, ``evaluations`` one RMSE per day.
    """
    base = first_n(features, [TS, "station_id"], baseline_rows)
    current = history(features, TS, asof=asof, lookback="1 day")
    worst = worst_feature(psi(base, current, columns))
    error = regression_metrics(predictions, "y", "yhat").select(F.col("rmse").alias("current_rmse"))
    usual = rolling_baseline(evaluations.withColumn("_m", F.lit(0)), ["_m"], "day", "rmse").select(F.col("baseline").alias("baseline_rmse"))
    # Three single rows, one above the other, become one.
    parts = union_sources(worst, error, usual)
    row = parts.agg(*[F.max(c).alias(c) for c in parts.columns]).where("worst_feature is not null and current_rmse is not null")
    error_parts = degradation(F.col("current_rmse"), F.col("baseline_rmse"), RMSE_DEGRADATION)
    row = row.withColumns(error_parts).withColumn("event_period", in_event_period(F.lit(asof)))
    row = row.withColumns(retrain_decision(F.col("max_psi"), F.col("degraded"), F.col("event_period")))
    text = drift_message(F.col("worst_feature"), F.col("max_psi"), F.lit(str(asof)))
    return row.withColumn("message", F.when(F.col("should_retrain"), text))


def publish_forecasts(features: DataFrame, hours: int = 24) -> DataFrame:
    """Forecast points of every station from its newest feature row."""
    newest = latest_per_key(features.select("station_id", TS, "pm25"), "station_id", [TS, "pm25"])
    return forecast_all(newest, "station_id", "pm25", F.col(TS), hours)


def publish_model_forecasts(features: DataFrame, model: SeasonalModel, hours: int = 24) -> DataFrame:
    """Forecast points of every station from its model, clamped and labelled; the closed form where it has none."""
    newest = latest_per_key(features.select("station_id", TS, "pm25"), "station_id", [TS, "pm25"])
    closed = forecast_all(newest, "station_id", "pm25", F.col(TS), hours)
    ahead = closed.select("station_id", "horizon", F.col("hour").alias(TS))
    own = served_forecasts(predict_seasonal(model, ahead, TS), "station_id", TS)
    rest = closed.join(own.select(F.col("station_id").alias("_s"), F.col("horizon").alias("_h")), (F.col("station_id") == F.col("_s")) & (F.col("horizon") == F.col("_h")), "left_anti")
    return own.unionByName(rest)


def features_to_online(readings: DataFrame, weather: DataFrame | None, calendar: DataFrame, path: str, run: str | None = None) -> DataFrame:
    """The feature job: compute, write by key into the stored table, read it back, newest row per station as keyed JSON.

    Run again, on the same or on overlapping readings, the table holds each station and hour once.
    """
    upsert(compute_features(readings, weather, calendar), path, FEATURES, stamp="computed_at", run=run)
    return online_snapshot(read_day_table(readings.sparkSession, path, FEATURES), "station_id", TS, "computed_at")


def hazard_alerts(latest: DataFrame, limit: float = HAZARD_PM25) -> DataFrame:
    """Messages for stations above the hazardous limit."""
    text = hazard_message(F.col("station_id"), F.col("pm25"), F.coalesce("aqi_us", F.lit(0)), F.date_format(TS, "yyyy-MM-dd HH:mm"), F.lit("stable"))
    return latest.where(F.col("pm25") > limit).select("station_id", TS, text.alias("message"))


@dataclass
class TrainingResult:
    seasonal: SeasonalModel
    scores: DataFrame
    weights: DataFrame
    blended: DataFrame


def train_and_blend(
    features: DataFrame, key: str, inputs: Sequence[str], *, target: str = "pm25", fraction: float = 0.8, horizon: int = 24,
    n_in: int = 48, spec: SeasonalSpec | None = None,
) -> TrainingResult:
    """Fit both forecasters on the first part of every series, score them on the rest, weigh the blend.

    The two forecasts and the actual meet by key, time and horizon.
    """
    # Both models, their scores and the weights read these rows again: kept in the shared folder.
    split = stored(chronological_split(features, key, TS, fraction), "training-split")
    train, valid = (split.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    seasonal = fit_seasonal(train, TS, target, spec=spec)
    multistep = fit_multistep(train, key, TS, inputs, target, n_in, horizon)
    windows = sequences(valid, key, TS, inputs, target, n_in, horizon)
    steps = predict_multistep(multistep, windows, [key, "y_ts"]).select(
        key, F.element_at("y_ts", F.col("horizon")).alias(TS), "horizon", F.col("forecast").alias("multistep"))
    level = predict_seasonal(seasonal, valid, TS).select(key, TS, F.col(target).alias("y"), F.col("yhat").alias("seasonal"))
    both = stored(align(steps, level, [key, TS]), "aligned-forecasts")
    weights = optimize_weights(both, "seasonal", "multistep", "y")
    best = weights.first()
    blended = both.withColumn("blend", best["weight_a"] * F.col("seasonal") + best["weight_b"] * F.col("multistep"))
    scores = union_sources(*[regression_metrics(blended, "y", m).withColumn("model", F.lit(m)) for m in ("seasonal", "multistep", "blend")])
    return TrainingResult(seasonal, scores, weights, blended)


def promotion(scores: DataFrame, champion_rmse: float | None) -> DataFrame:
    """Best model of a training run against the champion."""
    best = scores.agg(F.min(F.struct("rmse", "model")).alias("b")).select("b.*").withColumn("champion_rmse", F.lit(champion_rmse).cast("double"))
    new, old = F.col("rmse"), F.col("champion_rmse")
    return best.withColumns(compare(old, new)).withColumn("promoted", promote(old, new))
