"""Air-quality scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import AQI_LABELS, IMPOSSIBLE_PM25, PM25_LIMITS


def aqi_category(pm25: Column, *, missing: int | None = None) -> Column:
    """Category 0-5 of a PM2.5 value.

    ``missing=None`` keeps NULL as NULL; ``missing=0`` is the serving rule, where
    NULL and negative values fall into category 0.
    """
    expr = F.when(pm25.isNull() | F.isnan(pm25), F.lit(missing).cast("int"))
    for index, limit in enumerate(PM25_LIMITS):
        expr = expr.when(pm25 <= limit, F.lit(index))
    return expr.otherwise(F.lit(len(PM25_LIMITS)))


def aqi_label(category: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in AQI_LABELS]), category + 1)


def first_truthy(*values: Column) -> Column:
    """First value that is neither NULL nor 0; the last one is taken as it is."""
    *head, last = values
    return F.coalesce(*[F.nullif(v, F.lit(0.0)) for v in head], last)


def clamp_forecast(value: Column, lower: Column | None = None, upper: Column | None = None) -> dict[str, Column]:
    """Published bounds: value in [0, 500], lower >= 0, upper <= 1000, two decimals.

    A missing bound is 30 % off the clamped value.
    """
    v = F.greatest(F.lit(0.0), F.least(F.lit(500.0), value))
    lo = v * 0.7 if lower is None else F.coalesce(lower, v * 0.7)
    hi = v * 1.3 if upper is None else F.coalesce(upper, v * 1.3)
    return {
        "pm25_predicted": F.round(v, 2),
        "confidence_lower": F.round(F.greatest(F.lit(0.0), lo), 2),
        "confidence_upper": F.round(F.least(F.lit(1000.0), hi), 2),
    }


def spread(last_value: Column) -> Column:
    """Half width of the closed-form forecast interval."""
    return 1.96 * F.greatest(last_value * 0.15, F.lit(5.0))


def impossible(pm25: Column, limit: float = IMPOSSIBLE_PM25) -> Column:
    return pm25 > limit


def no_nan(value: Column) -> Column:
    """NaN to NULL: Spark aggregates treat NaN as a value."""
    return F.nanvl(value, F.lit(None).cast("double"))
