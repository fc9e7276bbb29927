"""Trailing statistics: exact for large offsets, linear in rows per window, whole over batch borders."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators.trailing import window_sums
from hazeline.operators.windows import time_lags, trailing

HOUR = 3_600_000_000


def test_large_offsets_keep_the_deviation():
    rng = np.random.default_rng(1)
    us = np.sort(rng.integers(0, 3 * 24 * HOUR, 5000))
    value = 1e6 + rng.normal(0, 1, 5000)
    _, _, mean, spread = window_sums(np.zeros(5000, np.int64), us, value, [HOUR, 24 * HOUR])[HOUR]
    for i in range(0, 5000, 97):
        own = value[(us > us[i] - HOUR) & (us <= us[i])]
        assert mean[i] == pytest.approx(own.mean(), rel=1e-14)
        assert spread[i] == pytest.approx(((own - own.mean()) ** 2).sum(), rel=1e-9, abs=1e-12)


def test_equal_values_have_no_deviation():
    us = np.arange(1000) * 60_000_000
    n, total, mean, spread = window_sums(np.zeros(1000, np.int64), us, np.full(1000, 0.1), [HOUR])[HOUR]
    assert np.sqrt(spread).max() < 1e-12 and np.allclose(mean, 0.1) and n[-1] == 60 and total[-1] == pytest.approx(6.0)


def test_cost_follows_the_rows():
    def spent(n):
        us = np.sort(np.random.default_rng(2).integers(0, 24 * HOUR, n))
        start = time.perf_counter()
        window_sums(np.zeros(n, np.int64), us, np.ones(n), [24 * HOUR])
        return time.perf_counter() - start

    spent(10_000)
    assert min(spent(400_000) for _ in range(3)) < 16 * min(spent(100_000) for _ in range(3))


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_groups_over_batch_borders(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = spark.range(400).select((F.col("id") % 3).alias("k"), F.timestamp_micros(F.col("id") * 20 * 60_000_000).alias("ts"),
                                       F.when(F.col("id") % 11 > 0, F.col("id").cast("double")).alias("v"), "id").repartition(3)
        spec = {"m": ("mean", 5), "s": ("sum", 2), "d": ("std", 3)}
        got = {r.id: r for r in trailing(rows, "k", "ts", "v", spec, chunk_us=30 * HOUR).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 400
    for i, r in got.items():
        seen = {h: [float(j) for j in range(i % 3, i + 1, 3) if j % 11 and (i - j) * 20 < h * 60] for h in (2, 3, 5)}
        assert r.m == (pytest.approx(np.mean(seen[5])) if seen[5] else None) and r.s == (pytest.approx(sum(seen[2])) if seen[2] else None)
        assert r.d == (pytest.approx(np.std(seen[3], ddof=1)) if len(seen[3]) > 1 else None)


def test_time_lags_keep_the_rows(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("a", 1, 9.0), ("a", 25, 3.0), ("b", 1, 4.0)], "k string, h int, v double")
    rows = rows.withColumn("ts", F.timestamp_seconds(F.col("h") * 3600))
    got = sorted((r.k, r.h, r.v, r.v_at_1h, r.v_at_24h) for r in time_lags(rows, "k", "ts", "v", [1, 24]).collect())
    assert got == [("a", 0, 1.0, None, None), ("a", 1, 2.0, 1.0, None), ("a", 1, 9.0, 1.0, None), ("a", 25, 3.0, None, 9.0), ("b", 1, 4.0, None, None)]
