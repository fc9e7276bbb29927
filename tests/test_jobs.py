"""Jobs, stored tables and messages on small fixtures."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline import schemas
from hazeline.plans import jobs
from hazeline.session import clear_work, stored
from hazeline.sources import feeds, messages, tables

T0 = dt.datetime(2025, 1, 1)


def features(spark, n=260, stations=("a", "b"), seed=0):
    rng = np.random.default_rng(seed)
    rows = [(s, T0 + dt.timedelta(hours=h), float(max(60 + 30 * np.sin(2 * np.pi * (h - 8) / 24) + rng.normal(0, 8), 5)), float(rng.uniform(20, 90)))
            for s in stations for h in range(n)]
    return spark.createDataFrame(rows, "station_id string, timestamp_utc timestamp_ntz, pm25 double, pm10 double")


def test_training_flow(spark):
    result = jobs.train_and_blend(features(spark), "station_id", ["pm25"], fraction=0.6)
    scores = {r["model"]: r["rmse"] for r in result.scores.collect()}
    assert scores["blend"] <= min(scores["seasonal"], scores["multistep"]) + 1e-9 and scores["blend"] < 20
    best = result.weights.first()
    assert best["weight_a"] + best["weight_b"] == pytest.approx(1.0)
    assert jobs.promotion(result.scores, None).first()["promoted"] and not jobs.promotion(result.scores, 0.1).first()["promoted"]


def test_drift_flow(spark):
    rows = features(spark)
    shifted = rows.withColumn("pm25", F.when(F.col("timestamp_utc") >= F.lit(T0 + dt.timedelta(hours=200)), F.col("pm25") + 200).otherwise(F.col("pm25")))
    predictions = spark.createDataFrame([(10.0, 12.0)] * 5, "y double, yhat double")
    runs = spark.createDataFrame([(i, 1.9) for i in range(9)], "day int, rmse double")
    asof = dt.datetime(2025, 7, 1)
    check = lambda df, p=predictions: jobs.drift_check(df, p, runs, asof=asof, columns=["pm25", "pm10"]).first()
    none_recent = check(rows)
    assert none_recent["max_psi"] == 0.0 and not none_recent["should_retrain"] and none_recent["message"] is None
    asof = T0 + dt.timedelta(hours=259)
    moved = check(shifted)
    assert moved["worst_feature"] == "pm25" and moved["event_period"] and moved["effective_threshold"] == 0.5 and moved["should_retrain"]
    assert "Feature: pm25" in moved["message"]
    worse = check(rows.where("false").unionByName(rows), spark.createDataFrame([(10.0, 14.0)], "y double, yhat double"))
    assert worse["degraded"] and worse["should_retrain"]


def test_alerts_and_hazard(spark):
    rows = features(spark, 60).withColumn("pm25", F.when(F.hour("timestamp_utc") < 4, 0.0).otherwise(F.col("pm25")))
    out = jobs.alerts(rows, columns=["pm25", "pm10"])
    assert out.columns == schemas.ALERT.names and out.where("alert_type = 'sensor_fault_stuck_zero'").count() == 2 * 3 * 2
    hot = spark.createDataFrame([("s", T0, 301.25, 350), ("t", T0, 300.0, 300)], "station_id string, timestamp_utc timestamp_ntz, pm25 double, aqi_us int")
    assert ["PM2.5: 301.2 µg/m³ (AQI: 350)" in r["message"] for r in jobs.hazard_alerts(hot).collect()] == [True]


def test_ingest_with_fallback(spark):
    row = lambda s, d, v: (s, "aqicn", 27.7, 85.3, T0 + dt.timedelta(days=d), v)
    frame = lambda rows: tables.ensure_columns(spark.createDataFrame(rows, "station_id string, source string, lat double, lon double, timestamp_utc timestamp_ntz, pm25 double"),
                                               {**{p: F.lit(None).cast("double") for p in ("pm10", "no2", "o3", "co")}, "aqi_us": F.lit(None).cast("int")})
    valid, held = jobs.ingest_readings(frame([row("s", 0, 1.0)]), frame([row("p", 0, 2.0)]), frame([row("f", 0, 3.0), row("f", 1, 4.0), row("f", 1, -4.0)]))
    assert sorted((r["station_id"], r["pm25"]) for r in valid.collect()) == [("f", 4.0), ("p", 2.0), ("s", 1.0)]
    assert [r["failures"][0]["column"] for r in held.collect()] == ["pm25"]


def test_append_by_name(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = features(spark, 50)
    tables.append(rows, path, schemas.READING)
    tables.append(rows.select("pm10", "pm25", "timestamp_utc", "station_id"), path, schemas.READING)
    back = tables.read_day_table(spark, path, schemas.READING)
    assert back.count() == 200 and back.where("ingested_at is null or lat is not null").count() == 0
    assert back.agg(F.sum("pm25")).first()[0] == pytest.approx(2 * rows.agg(F.sum("pm25")).first()[0])
    day = tables.history(spark.read.parquet(path), "timestamp_utc", station="a", start=T0, end=T0 + dt.timedelta(hours=3))
    assert day.count() == 8
    with pytest.raises(ValueError):
        tables.require_rows(rows, 168)


def test_messages_and_snapshot(spark):
    rows = spark.createDataFrame([("s", T0, float("nan")), (None, T0, 1.5)], "station_id string, timestamp_utc timestamp_ntz, pm25 double")
    sent = {r["key"]: json.loads(r["value"]) for r in messages.to_messages(rows).collect()}
    assert sent == {"s": {"station_id": "s", "timestamp_utc": "2025-01-01T00:00:00.000000", "pm25": None}, "unknown": {"station_id": None, "timestamp_utc": "2025-01-01T00:00:00.000000", "pm25": 1.5}}
    stamped = features(spark, 5).withColumn("computed_at", F.col("timestamp_utc"))
    snap = messages.online_snapshot(stamped, "station_id", "timestamp_utc", "computed_at", asof=T0 + dt.timedelta(hours=4)).collect()
    assert {r["key"] for r in snap} == {"features:a:latest", "features:b:latest"} and {r["expires_at"] for r in snap} == {T0 + dt.timedelta(hours=6)}


def test_forecast_points_per_station(spark):
    points = jobs.publish_forecasts(features(spark, 30))
    assert points.groupBy("station_id").count().where("count = 24").count() == 2


def test_stored_and_cleared(spark):
    kept = stored(spark.range(5), "probe")
    assert kept.count() == 5
    clear_work(spark)
    with pytest.raises(Exception):
        stored.__globals__["SparkSession"].getActiveSession().read.parquet(kept.inputFiles()[0]).count()


def test_union_keeps_names(spark):
    out = feeds.union_sources(spark.sql("select 1 a, 2 b"), spark.sql("select 3 b"))
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2), (None, 3)]


def test_worker_functions_travel_by_value():
    from pyspark.cloudpickle import cloudpickle

    assert "hazeline" in cloudpickle.list_registry_pickle_by_value()


def day_rows(rows):
    return [(s, T0 + dt.timedelta(hours=h), v) for s, h, v in rows]


def test_upsert_is_repeatable_and_touches_its_days_only(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "station_id string, timestamp_utc timestamp_ntz, pm25 double"
    first = spark.createDataFrame(day_rows([("a", 0, 1.0), ("a", 1, 2.0), ("b", 30, 3.0), ("b", 55, 4.0)]), schema)
    tables.upsert(first, path, schemas.READING, run="r1")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}
    second = spark.createDataFrame(day_rows([("a", 1, 9.0), ("c", 31, 5.0)]), schema)
    for _ in range(2):
        tables.upsert(second, path, schemas.READING, run="r2")
    got = sorted((r.station_id, r.timestamp_utc, r.pm25) for r in tables.read_day_table(spark, path, schemas.READING).collect())
    assert got == sorted(day_rows([("a", 0, 1.0), ("a", 1, 9.0), ("b", 30, 3.0), ("b", 55, 4.0), ("c", 31, 5.0)]))
    kept = {p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert [p.parent.name for p in kept] == [f"date={(T0 + dt.timedelta(hours=55)).date()}"]
    assert sorted((r.run, r.n_rows) for r in tables.finished_runs(spark, path).collect()) == [("r1", 4), ("r2", 2)]


def test_the_feature_job_run_twice_leaves_the_same_table(spark, tmp_path):
    rows = [("a" if i % 2 else "b", "openaq", 27.7, 85.3, T0 + dt.timedelta(hours=i), float(40 + i % 9)) for i in range(80)]
    readings = spark.createDataFrame(rows, "station_id string, source string, lat double, lon double, timestamp_utc timestamp_ntz, pm25 double")
    path, counts, shots = str(tmp_path / "features"), [], []
    for _ in range(2):
        shots.append({r.key for r in jobs.features_to_online(readings, None, tables.default_calendar(spark), path, run="same").collect()})
        counts.append(spark.read.parquet(path).groupBy("station_id").count().collect())
    assert sorted(counts[0]) == sorted(counts[1]) and sum(r["count"] for r in counts[1]) == 80 and shots[0] == shots[1]
    assert tables.finished_runs(spark, path).count() == 1
