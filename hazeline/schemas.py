"""Schemas of the stored tables and of the landed JSON feeds."""

from __future__ import annotations

from pyspark.sql import types as T

from .constants import LAG_ROWS, MEAN_WINDOWS_H, STD_WINDOWS_H


def _struct(spec: dict[str, T.DataType | str]) -> T.StructType:
    return T.StructType([
        T.StructField(n, T._parse_datatype_string(t) if isinstance(t, str) else t) for n, t in spec.items()
    ])


_D, _S, _B, _I, _TS = T.DoubleType(), T.StringType(), T.BooleanType(), T.IntegerType(), T.TimestampNTZType()

READING = _struct({
    "station_id": _S, "source": _S, "lat": _D, "lon": _D, "timestamp_utc": _TS,
    "pm25": _D, "pm10": _D, "no2": _D, "o3": _D, "co": _D, "aqi_us": _I, "ingested_at": _TS,
})
WEATHER = _struct({
    "lat": _D, "lon": _D, "timestamp_utc": _TS, "temp_c": _D, "humidity_pct": _D,
    "wind_speed_kmh": _D, "wind_dir_deg": _D, "precip_mm": _D, "pressure_hpa": _D, "ingested_at": _TS,
})
WARD_ESTIMATE = T.StructType(
    [f for f in READING.fields if f.name != "ingested_at"]
    + [T.StructField("kriging_variance", _D), T.StructField("ward_name", _S), T.StructField("ingested_at", _TS)]
)
FEATURES = _struct({
    "station_id": _S, "timestamp_utc": _TS,
    "pm25": _D, "pm10": _D, "no2": _D, "o3": _D, "co": _D, "aqi_us": _I, "lat": _D, "lon": _D,
    "hour_of_day": _I, "day_of_week": _I, "month": _I, "is_weekend": _B,
    "hour_sin": _D, "hour_cos": _D, "month_sin": _D, "month_cos": _D,
    **{f"pm25_{h}h_mean": _D for h in MEAN_WINDOWS_H},
    **{f"pm25_{h}h_std": _D for h in STD_WINDOWS_H},
    **{f"pm25_lag_{n}h": _D for n in LAG_ROWS},
    "temp_c": _D, "humidity_pct": _D, "wind_speed_kmh": _D, "wind_dir_sin": _D, "wind_dir_cos": _D,
    "precip_mm": _D, "pressure_hpa": _D, "precip_6h_cumulative": _D,
    "is_tihar": _B, "is_dashain": _B, "is_indra_jatra": _B,
    "is_monsoon": _B, "is_pre_monsoon": _B, "is_brick_kiln_season": _B, "is_public_holiday": _B,
    "aqi_us_category": _I, "station_distance_to_city_center_km": _D, "computed_at": _TS,
})
ALERT = _struct({
    "station_id": _S, "timestamp_utc": _S, "metric": _S, "value": _D, "anomaly_score": _D, "alert_type": _S,
})
CALENDAR = _struct({"date": T.DateType(), "festival_name": _S, "flag_column_name": _S})
WARDS = _struct({"ward_id": _I, "ward_name": _S, "lat": _D, "lon": _D})

# Landed feed documents.
CITY_FEED = (
    "struct<status:string,data:struct<aqi:int,iaqi:map<string,struct<v:double>>,"
    "time:struct<iso:string>,city:struct<geo:array<double>>>>"
)
SENSOR_FEED = (
    "struct<results:array<struct<id:bigint,name:string,"
    "coordinates:struct<latitude:double,longitude:double>,"
    "sensors:array<struct<id:bigint,parameter:struct<name:string>,"
    "measurements:array<struct<value:double,period:struct<datetimeFrom:struct<utc:string>>>>>>>>>"
)
HOURLY_FEED = (
    "struct<hourly:struct<time:array<string>,temperature_2m:array<double>,"
    "relative_humidity_2m:array<double>,wind_speed_10m:array<double>,"
    "wind_direction_10m:array<double>,precipitation:array<double>,surface_pressure:array<double>>>"
)
