"""As-of join, calendar, feeds and the feature table."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline import constants, schemas
from hazeline.operators.asof import nearest_asof
from hazeline.operators.calendar import add_calendar_flags
from hazeline.operators.chunks import HOUR_US
from hazeline.plans.features import compute_features
from hazeline.sources import feeds, tables

T0 = dt.datetime(2025, 1, 1)


def brute(left, right, tol):
    out = {}
    for i, t in left:
        near = [(abs((u - t).total_seconds()), -u.timestamp(), v) for u, v in right if abs((u - t).total_seconds()) <= tol]
        out[i] = min(near, key=lambda x: x[:2])[2] if near else None
    return out


@pytest.mark.parametrize("method,salts", [("lookup", None), ("window", 1), ("window", 3), ("auto", None)])
def test_nearest_against_brute_force(spark, method, salts):
    rng = random.Random(1)
    left = [(i, T0 + dt.timedelta(minutes=rng.randrange(0, 6000, 10))) for i in range(400)]
    times = sorted({T0 + dt.timedelta(minutes=rng.randrange(0, 6000, 20)) for _ in range(40)})
    right = [(u, None if rng.random() < 0.3 else float(k)) for k, u in enumerate(times)]
    l = spark.createDataFrame(left, "id int, ts timestamp_ntz")
    r = spark.createDataFrame(right, "ts timestamp_ntz, v double")
    got = {x["id"]: x["v"] for x in nearest_asof(l, r, "ts", ["v"], HOUR_US, method=method, salts=salts).collect()}
    assert got == brute(left, right, 3600)


@pytest.mark.parametrize("method", ["lookup", "window"])
def test_nearest_edges(spark, method):
    """A tie takes the later row, exactly the tolerance matches, one microsecond more does not."""
    l = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(hours=5)), (3, T0 + dt.timedelta(hours=9, microseconds=1))], "id int, ts timestamp_ntz")
    r = spark.createDataFrame(
        [(T0 - dt.timedelta(minutes=30), "early"), (T0 + dt.timedelta(minutes=30), "late"), (T0 + dt.timedelta(hours=4), "far"), (T0 + dt.timedelta(hours=8), "beyond")],
        "ts timestamp_ntz, v string")
    got = {x["id"]: x["v"] for x in nearest_asof(l, r, "ts", ["v"], HOUR_US, method=method).collect()}
    assert got == {1: "late", 2: "far", 3: None}


def test_calendar(spark):
    days = tables.default_calendar(spark)
    counts = {r["flag_column_name"]: r["count"] for r in days.groupBy("flag_column_name").count().collect()}
    assert counts == {"is_dashain": 120, "is_public_holiday": 84, "is_tihar": 40, "is_indra_jatra": 8}
    probes = spark.createDataFrame([(dt.datetime(2025, 10, 22, 5),), (dt.datetime(2025, 6, 15),), (dt.datetime(2025, 7, 15),), (dt.datetime(2025, 4, 15),), (dt.datetime(2020, 3, 10),)], "ts timestamp_ntz")
    out = add_calendar_flags(probes, days, "ts")
    assert out.count() == 5
    r = {x["ts"].strftime("%Y-%m-%d"): x for x in out.collect()}
    assert r["2025-10-22"]["is_tihar"] and r["2025-10-22"]["is_public_holiday"] and not r["2025-06-15"]["is_tihar"]
    assert r["2025-07-15"]["is_monsoon"] and not r["2025-07-15"]["is_pre_monsoon"]
    assert r["2025-04-15"]["is_pre_monsoon"] and not r["2025-04-15"]["is_monsoon"]
    assert r["2020-03-10"]["is_public_holiday"]
    late = spark.createDataFrame([(dt.datetime(2025, 10, 19, 20),)], "ts timestamp_ntz")
    assert not add_calendar_flags(late, days, "ts").first()["is_tihar"]
    assert add_calendar_flags(late, days, "ts", tz="Asia/Kathmandu").first()["is_tihar"]


def test_wards(spark):
    rows = tables.default_wards(spark).collect()
    assert len(rows) == 32 and rows[0]["ward_name"].endswith("Ward 1") and len({(r["lat"], r["lon"]) for r in rows}) == 32


def readings(spark, hours=72):
    rng = np.random.default_rng(5)
    rows = [(s, "openaq", T0 + dt.timedelta(hours=h), float(rng.uniform(30, 150)), float(rng.uniform(50, 200)), float(rng.uniform(5, 50)), 27.7172, 85.3240)
            for s in ("a", "b") for h in range(hours)]
    return spark.createDataFrame(rows, "station_id string, source string, timestamp_utc timestamp_ntz, pm25 double, pm10 double, no2 double, lat double, lon double")


def weather(spark, hours=72):
    rows = [(27.7, 85.3, T0 + dt.timedelta(hours=h), 10.0 + h, 50.0, 5.0, 90.0, 0.5, 860.0) for h in range(hours)]
    return spark.createDataFrame(rows, "lat double, lon double, timestamp_utc timestamp_ntz, temp_c double, humidity_pct double, wind_speed_kmh double, wind_dir_deg double, precip_mm double, pressure_hpa double")


def test_features(spark):
    raw = readings(spark)
    rows = compute_features(raw, weather(spark), tables.default_calendar(spark), chunk_us=30 * HOUR_US, block_rows=20)
    assert rows.schema.names == schemas.FEATURES.names and rows.count() == 144
    a = rows.where("station_id = 'a'").orderBy("timestamp_utc").toPandas()
    assert a.pm25_24h_mean[23] == pytest.approx(a.pm25[:24].mean()) and a.pm25_lag_1h[5] == a.pm25[4]
    assert a.pm25_1h_std.isna().all() and a.pm25_lag_48h[50] == a.pm25[2] and a.pm25_lag_168h.isna().all()
    assert a.hour_sin.between(-1, 1).all() and a.month_cos.between(-1, 1).all()
    assert a.temp_c[10] == 20.0 and a.wind_dir_sin[0] == pytest.approx(1.0) and a.precip_6h_cumulative[9] == pytest.approx(3.0)
    assert a.station_distance_to_city_center_km.abs().max() < 1e-6 and a.is_public_holiday[:24].all() and not a.is_public_holiday[24:].any()


def test_features_do_not_look_ahead(spark):
    """Dropping the future changes nothing in the past."""
    raw, w = readings(spark), weather(spark)
    cut = T0 + dt.timedelta(hours=40)
    past = lambda df: df.where(F.col("timestamp_utc") <= F.lit(cut))
    keep = [c for c in schemas.FEATURES.names if c != "computed_at"]
    calendar = tables.default_calendar(spark)
    whole = past(compute_features(raw, w, calendar)).select(keep).orderBy("station_id", "timestamp_utc").collect()
    short = compute_features(past(raw), past(w), calendar).select(keep).orderBy("station_id", "timestamp_utc").collect()
    assert whole == short


def test_features_without_weather_and_with_split_pollutants(spark):
    raw = readings(spark, 5)
    parts = raw.withColumn("pm10", F.lit(None).cast("double")).unionByName(raw.withColumn("pm25", F.lit(None).cast("double")))
    rows = compute_features(parts, None, tables.default_calendar(spark))
    assert rows.count() == 10 and rows.where("pm25 is null or pm10 is null or temp_c is not null").count() == 0


def test_city_feed(spark):
    doc = {"status": "ok", "data": {"aqi": 156, "iaqi": {"pm25": {"v": 78.5}}, "time": {"iso": "2025-01-01T12:00:00+05:45"}, "city": {"geo": [27.7, 85.3]}}}
    bad = {"status": "error", "data": {}}
    df = spark.createDataFrame([("center", json.dumps(doc)), ("gone", json.dumps(bad))], "name string, payload string")
    r = feeds.parse_city_feed(df, "payload", "name").collect()
    assert len(r) == 1 and r[0]["station_id"] == "aqicn_center" and r[0]["pm25"] == 78.5 and r[0]["aqi_us"] == 156
    assert r[0]["no2"] is None and r[0]["timestamp_utc"] == dt.datetime(2025, 1, 1, 6, 15) and r[0]["lat"] == 27.7


def test_sensor_feed(spark):
    m = lambda v: {"value": v, "period": {"datetimeFrom": {"utc": "2025-01-01T00:00:00Z"}}}
    doc = {"results": [{"id": 7, "name": "x", "coordinates": {"latitude": 27.7, "longitude": 85.3},
                        "sensors": [{"id": 1, "parameter": {"name": "PM25"}, "measurements": [m(1.5), m(2.5)]}, {"id": 2, "parameter": {"name": "humidity"}, "measurements": [m(9.0)]}]}]}
    r = feeds.parse_sensor_feed(spark.createDataFrame([(json.dumps(doc),)], "payload string"), "payload").collect()
    assert [x["pm25"] for x in r] == [1.5, 2.5, None] and {x["station_id"] for x in r} == {"7"} and all(x["pm10"] is None for x in r)


def test_hourly_feed(spark):
    doc = {"hourly": {"time": ["2025-01-01T00:00", "2025-01-01T01:00Z", "2025-01-01T02:00:00+05:45"], "temperature_2m": [1.0, 2.0, 3.0], "precipitation": [0.1]}}
    df = spark.createDataFrame([(27.7, 85.3, json.dumps(doc))], "lat double, lon double, payload string")
    r = feeds.parse_hourly_feed(df, "payload", "lat", "lon").collect()
    assert [x["temp_c"] for x in r] == [1.0, 2.0, 3.0] and [x["precip_mm"] for x in r] == [0.1, None, None] and r[0]["pressure_hpa"] is None
    assert [x["timestamp_utc"] for x in r] == [T0, T0 + dt.timedelta(hours=1), dt.datetime(2024, 12, 31, 20, 15)]


def test_missing_csv_is_empty(spark, tmp_path):
    assert tables.read_csv_dimension(spark, str(tmp_path / "none.csv"), schemas.WARDS).count() == 0


def test_constants_shape():
    assert len(constants.SEQUENCE_FEATURES) == 32 and len(constants.SEASONAL_REGRESSORS) == 7
