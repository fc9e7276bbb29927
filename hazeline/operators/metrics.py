"""Forecast scores, comparisons, blends and sanity reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import BLEND_WEIGHTS, BOX, RMSE_DEGRADATION
from ..functions.text import comparison_reason, degradation_reason
from .windows import last_rows


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), *, signed_mape: bool = False) -> DataFrame:
    """RMSE, MAE, MAPE and R² over rows where both sides are present; no such row gives NULLs.

    R² uses ``count * var_pop(y)`` for the total sum of squares, which is stable
    and combines map-side; a constant target gives 0.
    """
    both = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    error = F.when(both, F.col(y) - F.col(yhat))
    target = F.when(both, F.col(y))
    base = target if signed_mape else F.abs(target)
    squares, total = F.sum(error * error), F.count(error) * F.var_pop(target)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(error / F.greatest(base, F.lit(1e-8)))) * 100).alias("mape"),
        F.when(F.count(error) == 0, None).when(total > 0, 1 - squares / total).otherwise(F.lit(0.0)).alias("r2"),
        F.count(error).alias("n"),
    )


def horizon_rmse(df: DataFrame, horizon: str, y: str, yhat: str, by: Sequence[str] = (), n: int = 24, wide: bool = False) -> DataFrame:
    """RMSE per horizon step, long, or wide as ``rmse_h1`` to ``rmse_hN``."""
    rmse = F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2)))
    if not wide:
        return df.groupBy(*by, horizon).agg(rmse.alias("rmse"))
    step = lambda h: F.when(F.col(horizon) == h, F.pow(F.col(y) - F.col(yhat), 2))
    return df.groupBy(*by).agg(*[F.sqrt(F.avg(step(h))).alias(f"rmse_h{h}") for h in range(1, n + 1)])


def align(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions with their actuals by key, never by position."""
    return predictions.join(actuals, list(keys))


def weights(a: Column | float | None, b: Column | float | None, defaults=BLEND_WEIGHTS) -> tuple[Column, Column]:
    """Weights scaled to sum 1; a missing or zero weight takes its default first."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x).cast("double")
    wa = F.coalesce(F.nullif(as_col(a), F.lit(0.0)), F.lit(defaults[0]))
    wb = F.coalesce(F.nullif(as_col(b), F.lit(0.0)), F.lit(defaults[1]))
    return wa / (wa + wb), wb / (wa + wb)


def blend(df: DataFrame, a: str, b: str, wa=None, wb=None, name: str = "blend") -> DataFrame:
    wa, wb = weights(wa, wb)
    return df.withColumn(name, wa * F.col(a) + wb * F.col(b))


def blend_interval(lower: Column, upper: Column, other: Column, wa=None, wb=None, other_std: float = 10.0) -> dict[str, Column]:
    wa, wb = weights(wa, wb)
    half = 1.96 * other_std
    return {"lower": wa * lower + wb * (other - half), "upper": wa * upper + wb * (other + half)}


def optimize_weights(df: DataFrame, a: str, b: str, y: str, by: Sequence[str] = (), steps: int = 20) -> DataFrame:
    """Weight of ``a`` on a grid over [0, 1] with the lowest RMSE; the first minimum wins.

    One pass: with errors ea, eb the squared error at weight w is
    w²·Σea² + 2w(1-w)·Σea·eb + (1-w)²·Σeb², so the grid needs three sums only.
    """
    ea, eb = F.col(y) - F.col(a), F.col(y) - F.col(b)
    sums = df.groupBy(*by).agg(
        F.sum(ea * ea).alias("_aa"), F.sum(ea * eb).alias("_ab"), F.sum(eb * eb).alias("_bb"), F.count(ea + eb).alias("_n"))
    w = lambda i: i / F.lit(float(steps))
    grid = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: F.struct(
        F.sqrt(F.greatest(F.lit(0.0), (
            w(i) * w(i) * F.col("_aa") + 2 * w(i) * (1 - w(i)) * F.col("_ab") + (1 - w(i)) * (1 - w(i)) * F.col("_bb")
        )) / F.nullif("_n", F.lit(0))).alias("rmse"), w(i).alias("w")))
    best = sums.withColumn("_best", F.array_min(grid))
    return best.select(*by, F.col("_best.w").alias("weight_a"), (1 - F.col("_best.w")).alias("weight_b"), F.col("_best.rmse").alias("rmse"))


def rolling_baseline(df: DataFrame, by: Sequence[str], order: str, value: str, n: int = 7) -> DataFrame:
    """Mean of the last n evaluations per model; NULL when there is none."""
    return last_rows(df, list(by), order, n).groupBy(*by).agg(F.avg(value).alias("baseline"))


def degradation(current: Column, baseline: Column, threshold: float = RMSE_DEGRADATION) -> dict[str, Column]:
    change = (current - baseline) / F.nullif(baseline, F.lit(0.0))
    return {
        "degradation_pct": change * 100,
        "degraded": F.coalesce(change > threshold, F.lit(False)),
        "reason": degradation_reason(change, threshold),
    }


def select_best(runs: DataFrame, score: str, run: str, by: Sequence[str] = ()) -> DataFrame:
    """Run with the lowest score; ties take the smaller run id."""
    best = F.min(F.struct(score, run)).alias("_b")
    return runs.groupBy(*by).agg(best).select(*by, F.col(f"_b.{run}").alias(run), F.col(f"_b.{score}").alias(score))


def compare(champion: Column, challenger: Column) -> dict[str, Column]:
    known = champion.isNotNull() & challenger.isNotNull()
    return {
        "improvement_pct": F.when(known, (champion - challenger) / F.nullif(champion, F.lit(0.0)) * 100),
        "should_promote": F.coalesce(challenger < champion, F.lit(False)),
        "reason": F.when(known, comparison_reason(challenger, champion)).otherwise(F.lit("Missing metrics")),
    }


def promote(champion: Column, challenger: Column) -> Column:
    """Promote when there is no champion or the challenger is strictly better."""
    return champion.isNull() | F.coalesce(challenger < champion, F.lit(False))


def forecast_sanity(
    df: DataFrame, by: Sequence[str], value: str, *, top: float = 500.0, flat: float = 1.0, usual=(20.0, 350.0),
) -> DataFrame:
    """Counts of missing, negative, too large and unusual values, spread, and PASS / WARN / FAIL."""
    v = F.col(value)
    report = df.groupBy(*by).agg(
        F.count_if(v.isNull()).alias("n_null"), F.count_if(v < 0).alias("n_negative"),
        F.count_if(v > top).alias("n_over"), F.count_if((v < usual[0]) | (v > usual[1])).alias("n_unusual"),
        F.stddev_pop(v).alias("std"))
    bad = (F.col("n_null") + F.col("n_negative") + F.col("n_over")) > 0
    return report.withColumn("status", F.when(bad, "FAIL").when(F.col("std") < flat, "FAIL")
                             .when(F.col("n_unusual") > 0, "WARN").otherwise("PASS"))


def structure_check(
    df: DataFrame, by: Sequence[str], value: str, last_value: str, flat: float = 2.0, close: float = 1.0,
) -> DataFrame:
    """Does a forecast move away from the last known value?"""
    report = df.groupBy(*by).agg(
        F.stddev_pop(value).alias("std"), F.sqrt(F.avg(F.pow(F.col(value) - F.col(last_value), 2))).alias("rmse_from_last"))
    return report.withColumn("status", F.when(F.col("std") < flat, "FAIL").when(F.col("rmse_from_last") < close, "WARN").otherwise("PASS"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL when a side is constant, where ``corr`` fails."""
    a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))


def forecast_diagnostics(df: DataFrame, by: Sequence[str], order: str, y: str, yhat: str) -> DataFrame:
    """Spread, range, correlation with the actual and lag-1 autocorrelation of short forecasts.

    A forecast has a bounded number of steps, so a window per forecast is safe.
    """
    step = df.withColumn("_next", F.lead(yhat).over(Window.partitionBy(*by).orderBy(order)))
    out = step.groupBy(*by).agg(
        F.stddev_pop(yhat).alias("std"), (F.max(yhat) - F.min(yhat)).alias("range"),
        correlation(F.col(y), F.col(yhat)).alias("corr_actual"), correlation(F.col(yhat), F.col("_next")).alias("autocorr_1"))
    return out.withColumn("suspicious", F.coalesce(F.col("autocorr_1") > 0.99, F.lit(False)))


def ward_coverage(df: DataFrame, value: str = "pm25", n_wards: int = 32, top: float = 500.0, spread: float = 0.01, box=BOX) -> DataFrame:
    """All wards present, values valid, coordinates in the box, not all alike."""
    v = F.col(value)
    inside = F.col("lat").between(box["lat_min"], box["lat_max"]) & F.col("lon").between(box["lon_min"], box["lon_max"])
    ok = v.between(0, top)
    report = df.agg(
        F.countDistinct("ward_id").alias("n_wards"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_invalid"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("n_outside"), F.stddev_pop(F.when(ok, v)).alias("std"))
    return report.withColumn("status", F.when((F.col("n_wards") < n_wards) | (F.col("n_invalid") > 0) | (F.col("std") < spread), "FAIL")
                             .when(F.col("n_outside") > 0, "WARN").otherwise("PASS"))


def blend_consistency(df: DataFrame, a: str, b: str, published: str, by: Sequence[str] = (), weights_=BLEND_WEIGHTS) -> DataFrame:
    error = F.avg(F.abs(F.col(published) - (weights_[0] * F.col(a) + weights_[1] * F.col(b))))
    return df.groupBy(*by).agg(error.alias("consistency_error")).withColumn(
        "status", F.when(F.col("consistency_error") < 1.0, "PASS").when(F.col("consistency_error") < 5.0, "WARN").otherwise("FAIL"))


def anomaly_summary(df: DataFrame, score: str = "anomaly_score", flag: str = "is_anomaly", by: Sequence[str] = ()) -> DataFrame:
    n, hits = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.groupBy(*by).agg(n.alias("n"), hits.alias("n_anomalies"), (hits / F.nullif(n, F.lit(0))).alias("anomaly_rate"), F.avg(score).alias("mean_score"))


def standardize(df: DataFrame, columns: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """Population-standardised columns; statistics come from the rows ``fit_on`` selects.

    The statistics are one row of numbers, read once and used as literals.
    """
    source = df if fit_on is None else df.where(fit_on)
    stats = source.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                       *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return df.withColumns({
        c: (F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0) for i, c in enumerate(columns)})


def set_descriptor(df: DataFrame, by: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows"))


def forecast_summary(df: DataFrame, station: str, horizon: str, value: str, model: str) -> DataFrame:
    """Current value (first step), highest value of the next 24 steps and the model label."""
    return df.where(F.col(horizon) <= 24).groupBy(station).agg(
        F.min_by(value, horizon).alias("current"), F.max(value).alias("max_24h"), F.min_by(model, horizon).alias("model"))
