"""Series operators against plain windows and hand-made cases, with borders inside the data."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from hazeline.operators import chunks, windows as W
from hazeline.operators.chunks import HOUR_US, numbered, with_row_halo
from hazeline.operators.forecasts import against_naive, baseline_forecasts, history_from_lags

T0 = dt.datetime(2025, 1, 1)


def series(spark, n=400, stations=("hot", "cold"), gap=1.0, seed=3):
    """One station has ten times the rows of the other; times are irregular, some values are missing."""
    rng = random.Random(seed)
    rows = []
    for i, s in enumerate(stations):
        t = T0
        for k in range(n if i == 0 else n // 10):
            t += dt.timedelta(minutes=rng.choice([1, 20, 60, 60, 60, 300]) * gap)
            v = None if rng.random() < 0.1 else round(rng.choice([0.0, 0.0, 0.0, rng.uniform(0, 200)]), 2)
            rows.append((s, t, v, len(rows)))
    return spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, pm25 double, id long").repartition(5)


def table(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("chunk_hours", [1, 24, 50, 10_000])
def test_trailing_equals_plain_window_for_any_chunk(spark, chunk_hours):
    df = series(spark)
    spec = {"m6": ("mean", 6), "s24": ("std", 24), "t24": ("sum", 24)}
    got = W.trailing(df, "station_id", "ts", "pm25", spec, chunk_us=chunk_hours * HOUR_US)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = lambda h: Window.partitionBy("station_id").orderBy(us).rangeBetween(-h * HOUR_US + 1, 0)
    want = df.select("id", F.avg("pm25").over(w(6)), F.stddev_samp("pm25").over(w(24)), F.sum("pm25").over(w(24)))
    for a, b in zip(table(got, "id", *spec), table(want)):
        assert a == pytest.approx(b, nan_ok=True)


def test_measured_chunk_follows_the_densest_station(spark, monkeypatch):
    df = series(spark)
    assert chunks.measured_chunk(df, "station_id", "ts") == chunks.CHUNK_US
    monkeypatch.setattr(chunks, "TASK_ROWS", 6)
    densest = df.groupBy("station_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (24 * HOUR_US))).count().agg(F.max("count")).first()[0]
    assert chunks.measured_chunk(df, "station_id", "ts") == 24 * HOUR_US * 6 // densest
    assert chunks.measured_chunk(df, "station_id", "ts", 48 * HOUR_US) == 48 * HOUR_US
    got = W.trailing(df, "station_id", "ts", "pm25", {"m": ("mean", 2)}, chunk_us=None)
    want = W.trailing(df, "station_id", "ts", "pm25", {"m": ("mean", 2)})
    for a, b in zip(table(got, "id", "m"), table(want, "id", "m")):
        assert a == pytest.approx(b)


@pytest.mark.parametrize("block,chunk_hours", [(7, 3), (168, 24), (20_000, 10_000)])
def test_row_operators_equal_plain_windows_for_any_block(spark, block, chunk_hours):
    df = series(spark)
    opts = dict(block_rows=block, chunk_us=chunk_hours * HOUR_US)
    w = Window.partitionBy("station_id").orderBy("ts")
    lags = W.row_lags(df, "station_id", "ts", "pm25", [1, 3, 168], **opts)
    want = df.select("id", *[F.lag("pm25", n).over(w) for n in (1, 3, 168)])
    assert table(lags, "id", "pm25_lag_1h", "pm25_lag_3h", "pm25_lag_168h") == table(want)

    filled = W.forward_fill(df, "station_id", "ts", ["pm25"], chunk_us=chunk_hours * HOUR_US)
    want = df.select("id", F.coalesce(F.last("pm25", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)))
    assert table(filled, "id", "pm25") == table(want)

    seq = W.sequences(filled, "station_id", "ts", ["pm25"], "pm25", 5, 3, **opts).select("station_id", "ts", F.flatten("x").alias("x"), "y")
    both = filled.select("station_id", "ts", F.collect_list("pm25").over(w.rowsBetween(-4, 0)).alias("x"), F.collect_list("pm25").over(w.rowsBetween(1, 3)).alias("y"))
    want = both.where((F.size("x") == 5) & (F.size("y") == 3))
    key = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))
    assert key(seq) == key(want)


def test_running_numbers_are_complete(spark):
    df = series(spark)
    rows = numbered(df, "station_id", "ts", total="n", size_us=5 * HOUR_US).collect()
    for s in ("hot", "cold"):
        mine = sorted((r for r in rows if r["station_id"] == s), key=lambda r: r["ts"])
        assert [r["_seq"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r["n"] for r in mine} == {len(mine)}


def test_halo_repeats_borders_only(spark):
    rows = with_row_halo(spark.range(1, 101).withColumnRenamed("id", "seq"), "seq", before=3, after=2, size=10).collect()
    assert sum(r["_own"] for r in rows) == 100
    block = sorted(r["seq"] for r in rows if r["_block"] == 4)
    assert block == list(range(38, 53))


def test_stuck_rows_against_loop(spark):
    df = series(spark, 600)
    want, streak, last = [], 0, None
    for r in sorted(df.collect(), key=lambda r: (r["station_id"], r["ts"])):
        streak = 0 if r["station_id"] != last else streak
        last = r["station_id"]
        streak = streak + 1 if r["pm25"] == 0 else 0
        if streak >= 3:
            want.append(r["id"])
    for block in (3, 11, 10_000):
        got = W.stuck_rows(df, "station_id", "ts", "pm25", 3, block_rows=block, chunk_us=10 * HOUR_US)
        assert sorted(r["id"] for r in got.collect()) == sorted(want)


def test_split_first_values_and_context(spark):
    df = series(spark)
    pdf = df.toPandas().sort_values(["station_id", "ts"])
    split = {r["id"]: r["split"] for r in W.chronological_split(df, "station_id", "ts", chunk_us=6 * HOUR_US).collect()}
    for _, part in pdf.groupby("station_id"):
        cut = int(len(part) * 0.8)
        assert [split[i] for i in part["id"]] == ["train"] * cut + ["valid"] * (len(part) - cut)
    context = {r["station_id"]: r["context"] for r in W.last_context(df, "station_id", "ts", "pm25", 100).collect()}
    cold = pdf[pdf.station_id == "cold"].pm25.fillna(0).tolist()
    assert context["cold"] == [0.0] * (100 - len(cold)) + cold
    firsts = {r["station_id"]: r["pm25"] for r in W.first_values(df, "station_id", "ts", {"pm25": 5.0}).collect()}
    for s, part in pdf.groupby("station_id"):
        first = part.pm25.iloc[0]
        assert firsts[s] == first or (firsts[s] is None and pd.isna(first))


def test_dedup_and_coalesce(spark):
    rows = spark.createDataFrame(
        [("a", T0, None, 1.0, 1), ("a", T0, 5.0, None, 2), ("a", T0, 7.0, 8.0, 3)] * 50,
        "station_id string, ts timestamp_ntz, pm25 double, no2 double, arrival int")
    assert [r["arrival"] for r in W.dedup_first(rows, ["station_id", "ts"], ["arrival"]).collect()] == [1]
    assert W.coalesce_readings(rows, ["station_id", "ts"], ["pm25", "no2"], ["arrival"]).first()[2:] == (5.0, 1.0)


def test_baselines(spark):
    values = [float(v) for v in np.random.default_rng(0).uniform(20, 100, 60)]
    rows = [("long", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    rows += [("short", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(values[:30])]
    df = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, pm25 double")
    out = {(r["station_id"], r["horizon"]): r for r in baseline_forecasts(df, "station_id", "ts", "pm25").collect()}
    train = np.array(values[:-24])
    for h in range(1, 25):
        r = out["long", h]
        assert r["actual"] == values[-25 + h] and r["naive"] == train[-1]
        assert r["moving_average"] == pytest.approx(train[-24:].mean()) and r["seasonal_naive"] == values[-49 + h]
    assert len([k for k in out if k[0] == "short"]) == 30
    assert out["short", 1]["naive"] == values[29] and out["short", 9]["moving_average"] == pytest.approx(np.mean(values[6:30]))
    scores = {(r["station_id"], r["model"]): r for r in against_naive(baseline_forecasts(df, "station_id", "ts", "pm25"), ["station_id"]).collect()}
    rmse = lambda p: float(np.sqrt(np.mean((np.array(values[-24:]) - p) ** 2)))
    assert scores["long", "naive"]["rmse"] == pytest.approx(rmse(train[-1]))
    assert scores["long", "moving_average"]["vs_naive_pct"] == pytest.approx((1 - rmse(train[-24:].mean()) / rmse(train[-1])) * 100)


def test_history_from_lags(spark):
    df = spark.createDataFrame([(1.0, None, 3.0, 4.0), (1.0, None, None, 2.0)], "a double, b double, c double, d double")
    assert [r[0] for r in df.select(history_from_lags(["a", "b", "c", "d"])).collect()] == [[1.0, 3.0, 4.0], None]
