"""Geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import BOX, EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = (
        F.pow(F.sin(half_lat), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def in_box(lat: Column, lon: Column, box: dict[str, float] = BOX) -> Column:
    """Inclusive bounding box; a missing coordinate counts as 0."""
    zero = F.lit(0.0)
    return (
        F.coalesce(lat, zero).between(box["lat_min"], box["lat_max"])
        & F.coalesce(lon, zero).between(box["lon_min"], box["lon_max"])
    )
