"""Hourly features: readings, weather and calendar to the stored feature schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import (
    CENTER_LAT, CENTER_LON, LAG_ROWS, MEAN_WINDOWS_H, POLLUTANTS, PRECIP_WINDOW_H, STD_WINDOWS_H,
    WEATHER_COLUMNS, WEATHER_TOLERANCE_S,
)
from ..functions.air import aqi_category, no_nan
from ..functions.geo import haversine_km
from ..functions.timefns import clock_columns, direction
from ..operators.asof import nearest_asof
from ..operators.calendar import add_calendar_flags
from ..operators.chunks import BLOCK_ROWS, CHUNK_US, HOUR_US, chunk_offsets, measured_chunk, small_side, time_chunk, with_row_halo, with_time_halo
from ..operators.trailing import trailing_columns
from ..operators.windows import coalesce_readings, dedup_first, first_values, trailing
from ..functions.timefns import micros
from ..schemas import FEATURES
from ..session import stored
from ..sources.tables import conform, ensure_columns

TS = "timestamp_utc"


def clean_readings(readings: DataFrame) -> DataFrame:
    """One row per station and time, each pollutant's first value that is neither NULL nor NaN, in arrival order."""
    full = ensure_columns(readings, {**{p: F.lit(None).cast("double") for p in POLLUTANTS}, "aqi_us": F.lit(None).cast("int"),
                                     "ingested_at": F.lit(None).cast("timestamp_ntz")})
    full = full.withColumns({p: no_nan(F.col(p)) for p in POLLUTANTS})
    return coalesce_readings(full, ["station_id", TS], [*POLLUTANTS, "aqi_us", "lat", "lon"], ["ingested_at", "source"])


def series_columns(clean: DataFrame, value: str = "pm25", *, chunk_us: int = CHUNK_US, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Trailing means and deviations, then row lags.

    Statistics and the running number inside a chunk share one shuffle by
    (station, time chunk); lags take a second one by (station, row block).
    """
    spec = {f"{value}_{h}h_mean": ("mean", h) for h in MEAN_WINDOWS_H} | {f"{value}_{h}h_std": ("std", h) for h in STD_WINDOWS_H}
    spread = with_time_halo(clean, TS, max(MEAN_WINDOWS_H) * HOUR_US, chunk_us)
    stats = trailing_columns(spread, ["station_id", "_chunk"], "_us", value, spec, own="_own", place="_local").drop("_us", "_own")
    offsets = chunk_offsets(clean.withColumn("_chunk", time_chunk(micros(F.col(TS)), chunk_us)), ["station_id"], "_chunk")
    ranked = stats.join(offsets, ["station_id", "_chunk"]).withColumn("_seq", F.col("_local") + F.col("_before"))
    blocks = with_row_halo(ranked.drop("_chunk", "_local", "_before", "_total"), "_seq", before=max(LAG_ROWS), size=block_rows)
    by_row = Window.partitionBy("station_id", "_block").orderBy("_seq")
    lags = {f"{value}_lag_{n}h": F.lag(value, n).over(by_row) for n in LAG_ROWS}
    return blocks.withColumns(lags).where("_own").drop("_seq", "_block", "_own")


def prepare_weather(weather: DataFrame) -> DataFrame:
    """One row per time: first arrival wins; direction as sine and cosine; trailing rain sum."""
    base = ensure_columns(weather, {c: F.lit(None).cast("double") for c in (
        "temp_c", "humidity_pct", "wind_speed_kmh", "wind_dir_deg", "precip_mm", "pressure_hpa")})
    base = ensure_columns(base, {"ingested_at": F.lit(None).cast("timestamp_ntz"), "_place": F.lit(0)})
    single = dedup_first(base, [TS], ["ingested_at", "lat", "lon"])
    rain = trailing(single, "_place", TS, "precip_mm", {"precip_6h_cumulative": ("sum", PRECIP_WINDOW_H)})
    return rain.withColumns(direction(F.col("wind_dir_deg"))).select(TS, *WEATHER_COLUMNS)


def add_weather(df: DataFrame, weather: DataFrame | None, method: str = "auto") -> DataFrame:
    """Nearest weather within an hour; without weather the columns are NULL.

    Prepared weather is kept in the shared folder: it is small beside the
    readings, is read for its size check and for the join, and its file size lets
    Spark choose a broadcast before anything is shuffled.
    """
    if weather is None:
        return df.withColumns({c: F.lit(None).cast("double") for c in WEATHER_COLUMNS})
    return nearest_asof(df, stored(prepare_weather(weather), "weather"), TS, WEATHER_COLUMNS, WEATHER_TOLERANCE_S * 1_000_000, method=method)


def compute_features(
    readings: DataFrame, weather: DataFrame | None, calendar: DataFrame, *, tz: str = "UTC",
    chunk_us: int | None = None, block_rows: int = BLOCK_ROWS, weather_method: str = "auto",
) -> DataFrame:
    """All features, one row per station and time. A row depends on earlier rows only.

    Cleaned readings are stored once; statistics, row numbers and places are all
    taken from that copy. The chunk length is measured on it unless given.
    """
    clean = stored(clean_readings(readings), "clean-readings")
    if chunk_us is None:
        chunk_us = measured_chunk(clean, "station_id", TS, max(MEAN_WINDOWS_H) * HOUR_US)
    rows = series_columns(clean, chunk_us=chunk_us, block_rows=block_rows)
    rows = add_weather(rows, weather, weather_method)
    rows = rows.withColumns(clock_columns(F.col(TS))).withColumn("aqi_us_category", aqi_category(F.col("pm25")))
    rows = add_calendar_flags(rows, calendar, TS, tz)
    places = first_values(clean, "station_id", TS, {"lat": CENTER_LAT, "lon": CENTER_LON})
    places = places.select("station_id", haversine_km(
        F.col("lat"), F.col("lon"), F.lit(CENTER_LAT), F.lit(CENTER_LON)).alias("station_distance_to_city_center_km"))
    # Kept and counted, so that it is broadcast up to a checked size: a join planned
    # without a size would shuffle all feature rows by station.
    rows = rows.join(small_side(stored(places, "station-places")), "station_id").withColumn("computed_at", F.current_timestamp().cast("timestamp_ntz"))
    return conform(rows, FEATURES)
