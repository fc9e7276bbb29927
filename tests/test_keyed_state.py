"""Keyed streaming state: late rows, restarts, expiry and silence against batch forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazeline.operators.windows import dedup_first
from hazeline.streaming import jobs
from hazeline.streaming.keyed import state_rows

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "station_id string, timestamp_utc timestamp_ntz, pm25 double"
TS = "timestamp_utc"


def at(minutes, micro=0):
    return T0 + dt.timedelta(minutes=minutes, microseconds=micro)


def append(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in.parquet"))


def stream(spark, tmp_path):
    return jobs.stream_table(spark, str(tmp_path), "in", 1)


def alerts(spark, path):
    return sorted((r.station_id, r.timestamp_utc[:16], r.value, r.alert_type) for r in spark.read.parquet(str(path / "alerts")).collect())


def test_late_rows_and_a_restart(spark, tmp_path):
    """A late row is judged among the rows that are kept; a second run goes on from the checkpoint."""
    append(spark, tmp_path, [("a", at(0), 0.0), ("a", at(20), 0.0), ("b", at(0), 5.0), (None, at(1), 2000.0)])
    jobs.fault_stream(stream(spark, tmp_path), str(tmp_path / "out")).awaitTermination()
    assert alerts(spark, tmp_path / "out") == [("unknown", "2025-01-01T00:01", 2000.0, "sensor_fault_impossible_value")]
    # 00:10 comes late, between the two kept rows: it is only the second zero. 00:30 is the third of the newest rows.
    append(spark, tmp_path, [("a", at(10), 0.0)])
    append(spark, tmp_path, [("a", at(30), 0.0), ("b", at(10), None), ("b", at(20), 0.0)])
    query = jobs.fault_stream(stream(spark, tmp_path), str(tmp_path / "out"))
    query.awaitTermination()
    assert ("a", "2025-01-01T00:30", 0.0, "sensor_fault_stuck_zero") in alerts(spark, tmp_path / "out")
    assert len(alerts(spark, tmp_path / "out")) == 2 and len([p for p in query.recentProgress if p["numInputRows"]]) == 2
    kept = sorted((r.station_id or "", r.us, r.value) for r in state_rows(spark, str(tmp_path / "out" / "progress"), "recent").collect())
    assert [k[0] for k in kept] == ["", "a", "a", "b", "b"]


def test_state_is_written_for_the_stations_of_a_batch_only(spark, tmp_path):
    append(spark, tmp_path, [(f"s{i}", at(i % 7), 1.0) for i in range(400)])
    append(spark, tmp_path, [("s3", at(100), 0.0)])
    query = jobs.fault_stream(stream(spark, tmp_path), str(tmp_path / "out"))
    query.awaitTermination()
    puts = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in query.recentProgress if p["numInputRows"]]
    assert puts[0] >= 400 and puts[1] <= 10


def test_expired_stations_leave_the_state(spark, tmp_path):
    append(spark, tmp_path, [("old", at(0), 1.0), ("live", at(5), 2.0), ("live", at(5), 3.0)])
    append(spark, tmp_path, [("live", at(600), 4.0), ("live", at(590), 9.0)])
    append(spark, tmp_path, [("new", at(700), None)])
    query = jobs.latest_stream(stream(spark, tmp_path), str(tmp_path / "out"), "station_id", TS, ties=["pm25"])
    query.awaitTermination()
    held = jobs.latest_rows(spark, str(tmp_path / "out")).collect()
    assert {(r.station_id, r.timestamp_utc, r.pm25, r.expires_at) for r in held} == {("live", at(600), 4.0, at(720)), ("new", at(700), None, at(820))}
    changes = spark.read.parquet(str(tmp_path / "out" / "changes")).collect()
    assert {(r.station_id, r.timestamp_utc) for r in changes if r.expired} == {("old", at(0))}


def test_silence_is_told_while_it_lasts(spark, tmp_path):
    """Against plain Python over the whole table; late rows within the bound still fill gaps."""
    rnd, rows = random.Random(8), []
    for s in "abcdef":
        minute = 0
        for _ in range(40):
            minute += rnd.choice([30, 60, 180, 181, 400, 1500])
            rows.append((s, at(minute, rnd.choice([0, 0, 1, 999])), 1.0))
    rows.sort(key=lambda r: r[1])
    shuffled = rows[:]
    # Rows trade places with others less than two hours away.
    for i in range(len(rows) - 1):
        if rnd.random() < 0.3 and abs((shuffled[i][1] - shuffled[i + 1][1]).total_seconds()) < 3000:
            shuffled[i], shuffled[i + 1] = shuffled[i + 1], shuffled[i]
    for i in range(5):
        append(spark, tmp_path, shuffled[i * 48:(i + 1) * 48])
    got = jobs.drain(jobs.silence_stream(stream(spark, tmp_path), "station_id", TS), "t-silence").collect()
    newest, gap = max(r[1] for r in rows), dt.timedelta(hours=3)
    final = newest.replace(microsecond=newest.microsecond // 1000 * 1000) - dt.timedelta(hours=2)
    want = set()
    for s in "abcdef":
        times = sorted({r[1] for r in rows if r[0] == s})
        for t, after in zip(times, [*times[1:], None]):
            if (after is None or after - t > gap) and t + gap < final:
                want.add((s, t, t + gap))
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 20


def test_first_copy_stays_whole(spark, tmp_path):
    schema = "station_id string, timestamp_utc timestamp_ntz, pm25 double, arrival long, note string"
    rnd = random.Random(3)
    rows = [(s, at(60 * h), rnd.random(), 0, rnd.choice(["x", None])) for h in range(30) for s in "abc" for _ in range(3)]
    rows = [(*r[:3], i, r[4]) for i, r in enumerate(rows)]
    for i in range(3):
        append(spark, tmp_path, rows[i * 90:(i + 1) * 90], schema)
    first = jobs.dedup_first_stream(stream(spark, tmp_path), ["station_id"], TS, ["arrival"])
    got = {tuple(r) for r in jobs.drain(first, "t-first").collect()}
    want = dedup_first(spark.createDataFrame(rows, schema), ["station_id", TS], ["arrival"])
    assert got == {tuple(r) for r in want.where(F.col(TS) <= F.lit(at(60 * 29) - dt.timedelta(hours=2))).collect()} and len(got) == 28 * 3


@pytest.mark.parametrize("window, slide", [("5 minutes", "1 minute"), ("4 minutes", "2 minutes")])
def test_sliding_means_from_panes(spark, tmp_path, window, slide):
    rnd = random.Random(4)
    rows = [(s, at(0) + dt.timedelta(seconds=37 * i), rnd.choice([None, float(rnd.randint(0, 99))])) for i in range(600) for s in "ab"]
    for i in range(4):
        append(spark, tmp_path, rows[i * 300:(i + 1) * 300])
    panes = jobs.sliding_means(stream(spark, tmp_path), "station_id", TS, "pm25", window, slide)
    direct = jobs.station_means(stream(spark, tmp_path), "station_id", TS, "pm25", window, slide)
    a, b = ({tuple(r) for r in jobs.drain(d, "t-sliding").collect()} for d in (panes, direct))
    assert {r[:2] + (r[3],) for r in a} == {r[:2] + (r[3],) for r in b} and len(a) > 100
    means = {r[:2]: r[2] for r in b}
    assert all((r[2] is None) == (means[r[:2]] is None) and (r[2] is None or abs(r[2] - means[r[:2]]) < 1e-9) for r in a)
