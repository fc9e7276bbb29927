"""Streaming jobs over several micro-batches equal their batch forms."""

import datetime as dt
import random

from pyspark.sql import functions as F

from hazeline.operators.faults import sensor_faults
from hazeline.operators.windows import latest_per_key
from hazeline.streaming import jobs

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "station_id string, timestamp_utc timestamp_ntz, pm25 double"


def batches(spark, tmp_path, n=4):
    """Files in time order, one micro-batch each; runs of zeros cross the borders."""
    rng = random.Random(9)
    rows = [(s, T0 + dt.timedelta(minutes=37 * i + k), rng.choice([0.0, 0.0, 0.0, 40.0, 1500.0])) for i in range(120) for k, s in enumerate("abc")]
    size = len(rows) // n
    for i in range(n):
        spark.createDataFrame(rows[i * size:(i + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
    return spark.createDataFrame(rows, SCHEMA), str(tmp_path)


def test_faults_across_batches(spark, tmp_path):
    table, folder = batches(spark, tmp_path)
    query = jobs.fault_stream(jobs.stream_table(spark, folder, "in", 1), str(tmp_path / "out"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    columns = ["station_id", "timestamp_utc", "value", "alert_type"]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out" / "alerts")).select(columns).collect()))
    want = sorted(map(tuple, sensor_faults(table).select(columns).collect()))
    assert got == want and len(got) > 20


def test_latest_across_batches(spark, tmp_path):
    table, folder = batches(spark, tmp_path)
    query = jobs.latest_stream(jobs.stream_table(spark, folder, "in", 1), str(tmp_path / "out"), "station_id", "timestamp_utc")
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(jobs.last_batch(query, str(tmp_path / "out"))).select("station_id", "timestamp_utc", "pm25").collect()))
    assert got == sorted(map(tuple, latest_per_key(table, "station_id", ["timestamp_utc"]).collect()))


def test_final_windows_and_dedup_across_batches(spark, tmp_path):
    table, folder = batches(spark, tmp_path)
    means = jobs.drain(jobs.station_means(jobs.stream_table(spark, folder, "in", 1), "station_id", "timestamp_utc", "pm25"), "t-means")
    newest = table.agg(F.max("timestamp_utc")).first()[0] - dt.timedelta(hours=2)
    want = table.groupBy("station_id", F.date_trunc("hour", "timestamp_utc").cast("timestamp_ntz").alias("window_start")).agg(F.avg("pm25").alias("mean"), F.count(F.lit(1)).alias("n"))
    want = want.where(F.col("window_start") + F.expr("interval 1 hour") <= F.lit(newest))
    assert sorted(map(tuple, means.collect())) == sorted(map(tuple, want.select(means.columns).collect()))
    doubled = jobs.stream_table(spark, folder, "in", 1)
    doubled = doubled.select("station_id", "timestamp_utc", F.explode(F.array("pm25", "pm25")).alias("pm25"))
    kept = jobs.drain(jobs.dedup_stream(doubled, ["station_id"], "timestamp_utc").withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp_ntz")), "t-dedup")
    assert kept.count() == table.count() == kept.select("station_id", "timestamp_utc").distinct().count()
