"""Stuck values over stations of few rows each: no frame per station, missing values and times as before."""

import datetime as dt

import numpy as np
from pyspark.sql import Row

from hazeline.streaming import jobs
from hazeline.streaming.keyed import StuckValues

T0 = dt.datetime(2025, 1, 1)


class Recent:
    def __init__(self):
        self.held = []

    def get(self):
        return iter(self.held)

    def put(self, rows):
        self.held = list(rows)


def judged(parts, n=3):
    """Output of the processor over micro-batches of one station, and the state it leaves."""
    found, station = [], StuckValues("station_id", n, 0.0)
    station.recent = Recent()
    for part in parts:
        rows = (Row(station_id="s", us=t, value=v, high=h) for t, v, h in part)
        found += [tuple(r) for r in station.handleInputRows(("s",), rows, None)]
    return found, station.recent.held


def test_rows_come_and_go_one_by_one():
    parts = [[(10, 0.0, False), (None, 0.0, False), (20, 0.0, False)], [(30, 0.0, None), (30, None, False), (5, 2000.0, True)], [(40, float("nan"), True), (41, 0.0, False)]]
    found, held = judged(parts)
    assert found == [("s", 20, 0.0, "stuck"), ("s", 5, 2000.0, "high"), ("s", 40, None, "high")] and held == [(40, None), (41, 0.0)]
    assert judged([[(1, 0.0, False), (2, 7.0, True)]], 1) == ([("s", 1, 0.0, "stuck"), ("s", 2, 7.0, "high")], [])


def test_against_a_plain_walk():
    rng = np.random.default_rng(3)
    values = rng.choice([0.0, 0.0, 0.0, 4.0], 300).tolist()
    want = [(("s", t, 0.0, "stuck")) for t in range(2, 300) if values[t - 2:t + 1] == [0.0] * 3]
    cuts = [0, 1, 2, 90, 91, 300]
    assert judged([[(t, values[t], False) for t in range(a, b)] for a, b in zip(cuts, cuts[1:])])[0] == want


def test_faults_need_no_frame_per_station(spark, tmp_path):
    rows = [(f"s{i % 40}", T0 + dt.timedelta(minutes=i), 0.0) for i in range(120)]
    spark.createDataFrame(rows, "station_id string, timestamp_utc timestamp_ntz, pm25 double").coalesce(1).write.parquet(str(tmp_path / "in.parquet"))
    query = jobs.fault_stream(jobs.stream_table(spark, str(tmp_path), "in", 1), str(tmp_path / "out"))
    query.awaitTermination()
    assert "InPandas" not in query._jsq.explainInternal(False)
    assert spark.read.parquet(str(tmp_path / "out" / "alerts")).count() == 40
