"""Forecasters: closed form, naive baselines, seasonal regression, multi-step regression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import DEFAULT_LAST_VALUE, SEASONAL_REGRESSORS
from ..functions.air import aqi_category, aqi_label, clamp_forecast, spread
from ..functions.timefns import micros
from ..sources.tables import ensure_columns
from ..session import stored
from .chunks import BLOCK_ROWS, as_list, small_side
from .lagged import weighted_window_products, window_blocks, window_products
from .regression import LinearModel, fit_linear, fit_linear_by, dot, model_of, predict, reweighted
from .windows import last_rows

DAY_S = 86400.0


def diurnal_forecast(df: DataFrame, last: str, asof: Column, hours: int = 24, noise_seed: int | None = None) -> DataFrame:
    """Closed-form forecast, one row per (row, horizon): mean reversion times a daily cycle, at least 1."""
    # Long-run level 60, reversion 0.05 per hour, swing 0.3 with phase 8 h,
    # local time UTC + 5.75 h, noise deviation 3, floor 1.
    steps = df.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(hours))))
    h, v = F.col("horizon"), F.col(last)
    hour = (F.hour(asof) + 5.75 + h) % 24
    level = v + (60.0 - v) * (1 - F.exp(-0.05 * h))
    value = level * (1.0 + 0.3 * F.sin(2 * F.pi() * (hour - 8) / 24))
    if noise_seed is not None:
        value = value + 3 * F.randn(noise_seed)
    return steps.withColumn("forecast", F.greatest(value, F.lit(1.0)))


def last_known(live: Column, stale: Column | None = None, default: float = DEFAULT_LAST_VALUE) -> Column:
    """Live value, else the stale one, else the default; a live 0 counts as missing."""
    parts = [F.nullif(live, F.lit(0.0))] + ([stale] if stale is not None else [])
    return F.coalesce(*parts, F.lit(default))


def forecast_all(snapshot: DataFrame, station: str, last: str, asof: Column, hours: int = 24) -> DataFrame:
    """Published forecast points of every station: clamped value, category and interval."""
    if not 1 <= hours <= 72:
        raise ValueError("hours must be 1 to 72")
    base = snapshot.select(station, F.nanvl(last_known(F.col(last)), F.lit(DEFAULT_LAST_VALUE)).alias("_last"), asof.alias("_asof"))
    steps = diurnal_forecast(base, "_last", F.col("_asof"), hours)
    half = spread(F.col("_last"))
    points = clamp_forecast(F.col("forecast"), F.greatest(F.col("forecast") - half, F.lit(0.0)), F.col("forecast") + half)
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(500.0), F.col("forecast")))
    return steps.select(
        station, "horizon",
        F.timestamp_micros(micros(F.col("_asof")) + F.col("horizon").cast("long") * 3_600_000_000).cast("timestamp_ntz").alias("hour"),
        *[c.alias(n) for n, c in points.items()],
        aqi_label(aqi_category(clamped, missing=0)).alias("aqi_category"), F.lit("fallback_diurnal").alias("model_used"))


def baseline_forecasts(df: DataFrame, key: str | Sequence[str], ts: str, value: str, ties: Sequence[str] = (), h: int = 24) -> DataFrame:
    """Last h values per series with naive, moving-average and seasonal-naive forecasts.

    A series shorter than 2h is compared with itself and its seasonal forecast is
    the naive one. Only the last 2h rows of a series are ever gathered.
    """
    keys = as_list(key)
    recent = last_rows(df, keys, ts, 2 * h, ties)
    series = Window.partitionBy(*keys)
    back = F.col("_back")
    n = F.count(F.lit(1)).over(series)
    full = F.col("_n") == 2 * h
    cut = F.when(full, h).otherwise(0)
    marked = recent.withColumn("_n", n).withColumns({
        "naive": F.max(F.when(back == cut + 1, F.col(value))).over(series),
        "moving_average": F.avg(F.when((back > cut) & (back <= cut + h), F.col(value))).over(series),
        "_season": F.lag(value, h).over(series.orderBy(back.desc())),
    })
    rows = marked.where(~full | (back <= h))
    return rows.select(
        *keys, ts, F.when(full, h + 1 - back).otherwise(F.col("_n") + 1 - back).alias("horizon"),
        F.col(value).alias("actual"), "naive", "moving_average",
        F.when(full, F.col("_season")).otherwise(F.col("naive")).alias("seasonal_naive"))


def against_naive(forecasts: DataFrame, by: Sequence[str], models=("naive", "moving_average", "seasonal_naive"), actual: str = "actual") -> DataFrame:
    """RMSE, MAE and improvement over naive (percent) per model."""
    rmse = lambda m: F.sqrt(F.avg(F.pow(F.col(actual) - F.col(m), 2)))
    wide = forecasts.groupBy(*by).agg(
        *[rmse(m).alias(f"r_{m}") for m in models], *[F.avg(F.abs(F.col(actual) - F.col(m))).alias(f"a_{m}") for m in models])
    rows = F.array(*[F.struct(
        F.lit(m).alias("model"), F.col(f"r_{m}").alias("rmse"), F.col(f"a_{m}").alias("mae"),
        F.when(F.col("r_naive") > 0, (1 - F.col(f"r_{m}") / F.col("r_naive")) * 100).otherwise(F.lit(0.0)).alias("vs_naive_pct"))
        for m in models])
    return wide.select(*by, F.inline(rows))


def history_from_lags(columns: Sequence[str]) -> Column:
    """Non-null snapshot values in order; NULL when there are fewer than three."""
    values = F.array_compact(F.array(*columns))
    return F.when(F.size(values) >= 3, values)


@dataclass(frozen=True)
class SeasonalSpec:
    """Trend with hinges, Fourier seasons (period in days, order) and regressors.

    ``sparsity`` above 0 penalises the size of the trend's changes, so that most
    hinges stay straight. With ``widening``, intervals beyond the training time
    grow with the horizon: the trend is taken to change there as often and by
    as much, on average, as it did before.
    """

    start: datetime
    end: datetime
    seasons: tuple = ((365.25, 10), (7.0, 3), (1.0, 4))
    hinges: int = 25
    hinge_share: float = 0.8
    regressors: tuple = tuple(SEASONAL_REGRESSORS)
    ridge: float = 1e-3
    z: float = 1.2816
    sparsity: float = 0.0
    widening: bool = False


def seasonal_spec(df: DataFrame, ts: str, **options) -> SeasonalSpec:
    ends = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
    return SeasonalSpec(ends["a"], ends["b"], **options)


def seasonal_terms(spec: SeasonalSpec, ts: str) -> tuple[list[str], Column]:
    """Names and the array expression of the design row; everything is a column expression."""
    seconds = micros(F.col(ts)) / 1e6
    start = (spec.start - datetime(1970, 1, 1)).total_seconds()
    span = max((spec.end - spec.start).total_seconds(), 1.0)
    t = (seconds - start) / span
    names, terms = ["trend"], [t]
    for i in range(1, spec.hinges + 1):
        at = spec.hinge_share * i / (spec.hinges + 1)
        names.append(f"hinge_{i}")
        terms.append(F.greatest(t - at, F.lit(0.0)))
    for period, order in spec.seasons:
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * seconds / (period * DAY_S)
            names += [f"s{period:g}_{k}", f"c{period:g}_{k}"]
            terms += [F.sin(angle), F.cos(angle)]
    names += spec.regressors
    terms += [F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in spec.regressors]
    return names, F.array(*terms)


@dataclass
class SeasonalModel:
    spec: SeasonalSpec
    shared: LinearModel | None
    by: list[str]
    per_key: DataFrame | None


def fit_seasonal(df: DataFrame, ts: str, y: str = "pm25", by: str | Sequence[str] | None = None, spec: SeasonalSpec | None = None) -> SeasonalModel:
    """Seasonal regression, shared or one per key. Rows without a target are dropped; absent regressors are 0."""
    spec = spec or seasonal_spec(df, ts)
    ready = ensure_columns(df, dict.fromkeys(spec.regressors, 0.0)).where(F.col(y).isNotNull())
    names, x = seasonal_terms(spec, ts)
    target = F.array(F.col(y).cast("double"))
    keys = as_list(by)
    l1 = np.array([spec.sparsity if n.startswith("hinge_") else 0.0 for n in names]) if spec.sparsity > 0 else None
    if keys:
        return SeasonalModel(spec, None, keys, fit_linear_by(ready, x, target, names, keys, spec.ridge, l1))
    return SeasonalModel(spec, fit_linear(ready, x, target, names, 1, spec.ridge, l1), [], None)


def trend_variance(spec: SeasonalSpec, ts: str, change: Column) -> Column:
    """Variance of the trend ahead of the training time, if slopes go on changing by ``change`` on average.

    Changes of Laplace size have the variance 2 b^2; they come at the hinges'
    rate, and one at s moves the trend at t by its size times t - s.
    """
    span = max((spec.end - spec.start).total_seconds(), 1.0)
    ahead = F.greatest((micros(F.col(ts)) / 1e6 - (spec.end - datetime(1970, 1, 1)).total_seconds()) / span, F.lit(0.0))
    return 2.0 * change * change * (spec.hinges / spec.hinge_share) * F.pow(ahead, 3) / 3.0


def predict_seasonal(model: SeasonalModel, df: DataFrame, ts: str) -> DataFrame:
    """Add yhat, yhat_lower and yhat_upper."""
    spec = model.spec
    ready = ensure_columns(df, dict.fromkeys(spec.regressors, 0.0))
    _, x = seasonal_terms(spec, ts)
    if model.shared is not None:
        yhat, sigma = predict(model.shared, x), F.lit(float(model.shared.sigma[0]))
        change = F.lit(float(np.abs(model.shared.coef[1:spec.hinges + 1, 0]).mean()) if spec.hinges else 0.0)
        out = ready
    else:
        fitted = model.per_key.select(*model.by, F.col("intercept").alias("_b0"), F.col("coef").alias("_b"), F.col("sigma").alias("_sd"))
        # Models are kept and counted: up to 20,000 are broadcast, rows are not shuffled by station.
        out = ready.join(small_side(stored(fitted, "station-models"), 20_000), model.by)
        yhat, sigma = F.col("_b0") + dot(x, F.col("_b")), F.col("_sd")
        change = F.aggregate(F.slice("_b", 2, spec.hinges), F.lit(0.0), lambda a, v: a + F.abs(v)) / max(spec.hinges, 1)
    if spec.widening and spec.hinges:
        sigma = F.sqrt(sigma * sigma + trend_variance(spec, ts, change))
    out = out.withColumn("yhat", yhat).withColumn("_half", spec.z * sigma)
    return out.select(*df.columns, "yhat", (F.col("yhat") - F.col("_half")).alias("yhat_lower"), (F.col("yhat") + F.col("_half")).alias("yhat_upper"))


def seasonal_contributions(model: SeasonalModel, df: DataFrame, ts: str) -> DataFrame:
    """Add ``baseline``, the mean prediction, and ``parts``, each term's exact contribution: together they are yhat."""
    spec = model.spec
    names, x = seasonal_terms(spec, ts)
    ready = ensure_columns(df, dict.fromkeys(spec.regressors, 0.0))
    if model.shared is not None:
        m = model.shared
        coef, mean, intercept = (F.array(*[F.lit(float(v)) for v in c]) for c in (m.coef[:, 0], m.mean, [m.intercept[0]]))
        out, intercept = ready, intercept[0]
    else:
        fitted = model.per_key.select(*model.by, F.col("intercept").alias("_b0"), F.col("coef").alias("_b"), F.col("mean").alias("_m"))
        out = ready.join(small_side(stored(fitted, "station-models"), 20_000), model.by)
        coef, mean, intercept = F.col("_b"), F.col("_m"), F.col("_b0")
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("f"), F.zip_with(x, mean, lambda a, b: a - b).alias("d"), coef.alias("b"))
    parts = F.transform(named, lambda p: F.struct(p["f"].alias("feature"), (p["d"] * p["b"]).alias("contribution")))
    return out.select(*df.columns, (intercept + dot(mean, coef)).alias("baseline"), parts.alias("parts"))


def served_forecasts(predicted: DataFrame, station: str, ts: str, label: str = "seasonal_regression") -> DataFrame:
    """Published points from yhat and its interval, with the columns of ``forecast_all``."""
    points = clamp_forecast(F.col("yhat"), F.greatest(F.col("yhat_lower"), F.lit(0.0)), F.col("yhat_upper"))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(500.0), F.col("yhat")))
    return predicted.select(station, "horizon", F.col(ts).alias("hour"), *[c.alias(n) for n, c in points.items()],
                            aqi_label(aqi_category(clamped, missing=0)).alias("aqi_category"), F.lit(label).alias("model_used"))


def future_hours(df: DataFrame, key: str | Sequence[str], ts: str, hours: int = 24) -> DataFrame:
    """The next hours after each key's newest row; regressors are absent, hence 0."""
    keys = as_list(key)
    ends = df.groupBy(*keys).agg(F.max(ts).alias("_end"))
    step = F.explode(F.sequence(F.lit(1), F.lit(hours)))
    return ends.withColumn("horizon", step).select(
        *keys, "horizon", F.timestamp_micros(micros(F.col("_end")) + F.col("horizon").cast("long") * 3_600_000_000).cast("timestamp_ntz").alias(ts))


def flat_inputs(x: str = "x") -> Column:
    """Window inputs as one vector, oldest step first."""
    return F.flatten(x)


@dataclass
class MultiStepModel:
    model: LinearModel
    inputs: list[str]
    n_in: int
    n_out: int


def fit_multistep(
    df: DataFrame, key: str | Sequence[str], ts: str, inputs: Sequence[str], target: str,
    n_in: int = 48, n_out: int = 24, ridge: float = 1e-2, ties: Sequence[str] = (), *,
    loss: str = "squared", delta: float = 1.0, rounds: int = 30, block_rows: int = BLOCK_ROWS,
) -> MultiStepModel:
    """Direct forecaster: all horizons regressed on the flattened input window.

    Windows are never copied: blocks of rows give their cross-products by lag.
    Under the ``huber`` loss, squared up to ``delta`` and linear beyond, each
    round weighs the windows of a block by how far the model before misses them.
    """
    if loss not in ("squared", "huber"):
        raise ValueError(f"unknown loss {loss}")
    blocks = window_blocks(df, key, ts, inputs, target, n_in, n_out, ties, block_rows)
    names = [f"{c}_t{i - n_in + 1}" for i in range(n_in) for c in inputs]
    if loss == "huber":
        blocks = stored(blocks, "window-blocks")
    model = model_of(window_products(blocks, key, n_in, n_out), names, n_out, ridge)
    if loss == "huber":
        model = reweighted(model, lambda coef, intercept: weighted_window_products(blocks, key, n_in, n_out, len(names), coef, intercept, delta), ridge, rounds, 1e-6)
    return MultiStepModel(model, list(inputs), n_in, n_out)


def predict_multistep(model: MultiStepModel, windows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, horizon, forecast) for every window.

    One product per batch over all horizons: the coefficient matrix is far too
    wide for column expressions.
    """
    coef, intercept = model.model.coef, model.model.intercept

    @F.pandas_udf("array<double>")
    def apply(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(x.to_numpy()) @ coef + intercept))

    out = windows.select(*keep, apply(flat_inputs()).alias("_f"))
    return out.select(*keep, F.posexplode("_f").alias("_i", "forecast")).withColumn("horizon", F.col("_i") + 1).drop("_i")
