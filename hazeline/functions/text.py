"""Message texts and JSON coding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import FEATURE_DESCRIPTIONS


def prefixed(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix), name.cast("string"))


def describe_feature(feature: Column) -> Column:
    """Plain-language name of a feature; unknown ones lose their underscores."""
    pairs = [F.lit(x) for kv in FEATURE_DESCRIPTIONS.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[feature], F.replace(feature, F.lit("_"), F.lit(" ")))


def fixed(value: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals, as printf writes it; -0.04 is "-0.0".

    Spark rounds the shortest decimal form of a double; printf rounds its exact
    value, and exact halves to even. The value is cut in two parts whose products
    with a small integer are exact, so its side of the nearest half is certain.
    """
    scale = 10**digits
    size = F.abs(value)
    high = size * 134217729.0 - (size * 134217729.0 - size)
    whole = F.floor(size * float(scale)).cast("long")
    beyond = (high * float(2 * scale) - (2 * whole + 1)) + (size - high) * float(2 * scale)
    units = whole + F.when((beyond > 0) | ((beyond == 0) & (whole % 2 == 1)), 1).otherwise(0)
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.format_string(f"%d.%0{digits}d", F.floor(units / scale).cast("long"), units % scale))


def comparison_reason(challenger: Column, champion: Column) -> Column:
    better = challenger < champion
    return F.concat(
        F.lit("Challenger RMSE ("), fixed(challenger, 2), F.lit(") is "),
        F.when(better, F.lit("better")).otherwise(F.lit("worse")),
        F.lit(" than champion ("), fixed(champion, 2), F.lit("). "),
        F.when(better, F.lit("Promoting.")).otherwise(F.lit("Keeping current champion.")),
    )


def degradation_reason(change: Column, threshold: float) -> Column:
    pct, limit = fixed(change * 100, 1), str(threshold * 100)
    return (
        F.when(change > threshold, F.concat(
            F.lit("Model degraded by "), pct, F.lit(f"% (threshold: {limit}%). Triggering retraining.")))
        .when(change.isNotNull(), F.concat(
            F.lit("Model performance within bounds: "), pct, F.lit(f"% degradation (threshold: {limit}%)")))
        .otherwise(F.lit("No valid baseline"))
    )


def hazard_message(station: Column, pm25: Column, aqi: Column, when: Column, trend: Column) -> Column:
    return F.concat(
        F.lit("🔴 <b>HAZARDOUS AIR QUALITY ALERT</b>\n\nStation: "), station,
        F.lit(", Kathmandu\nPM2.5: "), fixed(pm25, 1), F.lit(" µg/m³ (AQI: "), aqi.cast("string"),
        F.lit(")\nTime: "), when, F.lit(" (NPT)\nForecast next 6h: "), trend,
        F.lit("\n\n⚠️ Wear N95 mask. Avoid outdoor activity."),
    )


def drift_message(feature: Column, psi: Column, run_id: Column) -> Column:
    return F.concat(
        F.lit("⚠️ <b>MODEL DRIFT DETECTED</b>\n\nFeature: "), feature,
        F.lit("\nPSI Score: "), fixed(psi, 3), F.lit(" (threshold: 0.25)\nAction: Emergency retrain triggered.\nRun ID: "),
        run_id,
    )


def retrain_message(model: Column, version: Column, new_rmse: Column, old_rmse: Column) -> Column:
    gain = F.when(old_rmse > 0, (old_rmse - new_rmse) / old_rmse * 100).otherwise(F.lit(0.0))
    return F.concat(
        F.lit("✅ <b>MODEL RETRAIN COMPLETE</b>\n\nNew champion: "), model, F.lit(" v"), version.cast("string"),
        F.lit("\nVal RMSE: "), fixed(new_rmse, 2), F.lit(" (prev: "), fixed(old_rmse, 2),
        F.lit(")\nImprovement: "), fixed(gain, 1), F.lit("%"),
    )


def driver_sentence(feature: Column, value: Column) -> Column:
    return F.concat(
        describe_feature(feature), F.lit(" "),
        F.when(value > 0, F.lit("increased")).otherwise(F.lit("decreased")),
        F.lit(" PM2.5 by "), fixed(F.abs(value), 1), F.lit(" µg/m³"),
    )


def json_text(*names: str) -> Column:
    """Row as JSON; NULLs are kept so readers see every field."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
