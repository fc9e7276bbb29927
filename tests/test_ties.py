"""Rows of equal time: the result does not depend on how rows arrive."""

import datetime as dt
import random

from hazeline.operators.faults import sensor_faults
from hazeline.plans.jobs import publish_forecasts
from hazeline.streaming import jobs

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "station_id string, timestamp_utc timestamp_ntz, pm25 double"


def doubled():
    rnd = random.Random(4)
    return [(s, T0 + dt.timedelta(minutes=10 * i), v) for i in range(60) for s in "ab" for v in rnd.choice([[0.0], [0.0, 0.0], [0.0, 30.0], [12.0]])]


def found(frame):
    return sorted(map(tuple, frame.collect()))


def test_faults_of_equal_times(spark):
    rows = doubled()
    first = found(sensor_faults(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    random.Random(1).shuffle(rows)
    assert first == found(sensor_faults(spark.createDataFrame(rows, SCHEMA).repartition(5))) and first


def test_forecasts_of_equal_times(spark):
    rows = doubled()
    first = found(publish_forecasts(spark.createDataFrame(rows, SCHEMA)))
    assert first == found(publish_forecasts(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4)))


def test_expired_state_goes_and_is_served_as_the_default(spark, tmp_path):
    days = [("old", T0, 9.0), ("live", T0, 5.0), ("live", T0 + dt.timedelta(hours=5), 7.0), ("late", T0 + dt.timedelta(hours=2, minutes=55), 8.0)]
    for i in range(3):
        part = [r for r in days if (r[1] - T0) // dt.timedelta(hours=2) == i]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))
    query = jobs.latest_stream(jobs.stream_table(spark, str(tmp_path), "in", 1), str(tmp_path / "out"), "station_id", "timestamp_utc")
    query.awaitTermination()
    state = spark.read.parquet(jobs.last_batch(query, str(tmp_path / "out")))
    assert {r.station_id for r in state.collect()} == {"live", "late"}
    names = spark.createDataFrame([("old",), ("live",), ("late",)], "station_id string")
    served = jobs.served_values(names, state, T0 + dt.timedelta(hours=5), "station_id", "pm25")
    assert {r.station_id: r.served for r in served.collect()} == {"old": 50.0, "live": 7.0, "late": 8.0}
    assert not (tmp_path / "out" / "state" / "v0").exists() and (tmp_path / "out" / "state" / "v2").exists()
