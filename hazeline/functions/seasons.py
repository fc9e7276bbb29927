"""Season flags and event-period rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import EVENT_MULTIPLIER, PSI_RETRAIN


def season_flags(ts: Column) -> dict[str, Column]:
    month = F.month(ts)
    return {
        "is_monsoon": month.between(6, 9),
        "is_pre_monsoon": month.between(3, 5),
        "is_brick_kiln_season": (month >= 10) | (month <= 5),
    }


def in_event_period(ts: Column) -> Column:
    """Dates on which drift is expected; month * 100 + day makes each period one range.

    Fixed values: kiln season 1 Jan-15 Apr, 1-10 Sep, 1-15 Oct, 25 Oct-5 Nov.
    """
    periods = [(101, 415), (901, 910), (1001, 1015), (1025, 1105)]
    day = F.month(ts) * 100 + F.dayofmonth(ts)
    rule = F.lit(False)
    for first, last in periods:
        rule = rule | day.between(first, last)
    return rule


def event_threshold(event: Column, threshold: float = PSI_RETRAIN, factor: float = EVENT_MULTIPLIER) -> Column:
    return F.when(event, F.lit(threshold * factor)).otherwise(F.lit(threshold))
