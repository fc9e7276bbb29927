"""Per-prediction drivers and their sentence.

Contributions of one prediction stay together as an array, so ranking and
wording them needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import driver_sentence, fixed


def ranked(parts: Column, k: int) -> Column:
    """The k contributions largest in absolute value, ties by feature name."""
    keyed = F.transform(parts, lambda p: F.struct(
        (-F.abs(p["contribution"])).alias("o"), p["feature"].alias("feature"), p["contribution"].alias("contribution")))
    return F.slice(F.array_sort(keyed), 1, k)


def top_contributors(df: DataFrame, keys: Sequence[str], parts: str, k: int = 10) -> DataFrame:
    """(keys, rank, feature, contribution, direction) of the strongest k contributions."""
    rows = df.select(*keys, F.posexplode(ranked(F.col(parts), k)).alias("_i", "_p"))
    value = F.col("_p.contribution")
    return rows.select(
        *keys, (F.col("_i") + 1).alias("rank"), F.col("_p.feature").alias("feature"), value.alias("contribution"),
        F.when(value > 0, "increases").otherwise("decreases").alias("direction"))


def explanation(parts: Column, prediction: Column, k: int = 5, minimum: float = 0.5) -> Column:
    """One sentence from the strongest k contributions of at least ``minimum``."""
    strong = F.filter(ranked(parts, k), lambda p: F.abs(p["contribution"]) >= minimum)
    said = F.transform(strong, lambda p: driver_sentence(p["feature"], p["contribution"]))
    head = fixed(prediction, 1)
    return F.when(F.size(strong) == 0, F.concat(F.lit("Current PM2.5 prediction: "), head, F.lit(" µg/m³ (no dominant single factor)"))).otherwise(
        F.concat(F.lit("Predicted PM2.5: "), head, F.lit(" µg/m³. Key drivers: "), F.array_join(said, "; "), F.lit(".")))
