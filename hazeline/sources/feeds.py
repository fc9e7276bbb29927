"""Landed JSON feeds to flat readings. Input frames hold one document per row; NaN in them becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import POLLUTANTS
from ..functions.air import no_nan
from ..functions.timefns import parse_iso
from ..schemas import CITY_FEED, HOURLY_FEED, SENSOR_FEED
from .tables import spread


def parse_city_feed(df: DataFrame, payload: str, name: str, lat: str | None = None, lon: str | None = None) -> DataFrame:
    """City-index documents: a pollutant map, an ISO time and a coordinate pair.

    Documents whose status is not ``ok`` are dropped. Known station coordinates
    win over the document's; without either the coordinate is 0.
    """
    doc = spread(df).withColumn("_d", F.from_json(payload, CITY_FEED)).where("_d.status = 'ok'").withColumn("_d", F.col("_d.data"))

    def coordinate(known: str | None, index: int) -> Column:
        own = F.get("_d.city.geo", index)
        return F.coalesce(*([F.col(known)] if known else []), own, F.lit(0.0))

    return doc.select(
        F.concat(F.lit("aqicn_"), F.col(name)).alias("station_id"),
        F.lit("aqicn").alias("source"),
        coordinate(lat, 0).alias("lat"), coordinate(lon, 1).alias("lon"),
        parse_iso(F.col("_d.time.iso")).alias("timestamp_utc"),
        *[no_nan(F.col("_d.iaqi")[p]["v"]).alias(p) for p in POLLUTANTS],
        F.col("_d.aqi").alias("aqi_us"),
    )


def parse_sensor_feed(df: DataFrame, payload: str) -> DataFrame:
    """Location documents flattened to one row per measurement, routed by lower-cased parameter name."""
    rows = (
        spread(df).select(F.explode(F.from_json(payload, SENSOR_FEED)["results"]).alias("loc"))
        .select("loc", F.explode("loc.sensors").alias("sensor"))
        .select("loc", F.lower("sensor.parameter.name").alias("parameter"), F.explode("sensor.measurements").alias("m"))
    )
    return rows.select(
        F.col("loc.id").cast("string").alias("station_id"),
        F.lit("openaq").alias("source"),
        F.col("loc.coordinates.latitude").alias("lat"), F.col("loc.coordinates.longitude").alias("lon"),
        parse_iso(F.col("m.period.datetimeFrom.utc")).alias("timestamp_utc"),
        *[F.when(F.col("parameter") == p, no_nan(F.col("m.value"))).alias(p) for p in POLLUTANTS],
        F.lit(None).cast("int").alias("aqi_us"),
    )


def parse_hourly_feed(df: DataFrame, payload: str, lat: str, lon: str) -> DataFrame:
    """Parallel hourly arrays to rows; the time array sets the rows, shorter arrays give NULL."""
    # Feed field -> column.
    fields = {
        "temperature_2m": "temp_c", "relative_humidity_2m": "humidity_pct",
        "wind_speed_10m": "wind_speed_kmh", "wind_direction_10m": "wind_dir_deg",
        "precipitation": "precip_mm", "surface_pressure": "pressure_hpa",
    }
    doc = spread(df).select(lat, lon, F.from_json(payload, HOURLY_FEED)["hourly"].alias("h"))
    doc = doc.select(lat, lon, "h.time", *[F.coalesce(f"h.{f}", F.array().cast("array<double>")).alias(c) for f, c in fields.items()])
    rows = doc.select(lat, lon, F.explode(F.arrays_zip("time", *fields.values())).alias("r")).where("r.time is not null")
    return rows.select(
        F.col(lat).alias("lat"), F.col(lon).alias("lon"), parse_iso(F.col("r.time")).alias("timestamp_utc"),
        *[no_nan(F.col(f"r.{c}")).alias(c) for c in fields.values()],
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """One reading schema from several sources, by column name."""
    out, *rest = frames
    for frame in rest:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def primary_else_fallback(primary: DataFrame, fallback: DataFrame, batch: list[str]) -> DataFrame:
    """Fallback rows only for batches the primary source has nothing for."""
    have = primary.select(*batch).distinct()
    return union_sources(primary, fallback.join(have, batch, "left_anti"))
