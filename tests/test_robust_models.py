"""Huber regression, training by lagged products, and contributions of the forest, against brute force."""

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazeline.operators import forecasts, iforest
from hazeline.operators.lagged import window_blocks, window_products
from hazeline.operators.regression import cross_products, fit_huber, fit_linear
from hazeline.operators.windows import sequences

T0 = dt.datetime(2025, 1, 1)


def plain_huber(x, y, delta, steps=20_000):
    """Minimiser of the mean Huber loss by plain gradient steps on scaled inputs."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        w += 0.3 * z.T @ np.clip(y - z @ w, -delta, delta) / len(y)
    coef = w[1:] / scale
    return coef, w[0] - mean @ coef


def test_outliers_pull_with_bounded_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal([3, -2], [1, 4], (500, 2))
    y = np.column_stack([2 + x @ [1.5, -0.5], -1 + x @ [0.2, 0.7]]) + rng.normal(0, 0.3, (500, 2))
    y[:40, 0] += 60
    y[60:80, 1] -= 45
    rows = [(float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(x, y)] + [(None, 1.0, 2.0, 3.0), (1.0, float("nan"), 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    model = fit_huber(df, F.array("a", "b"), F.array("c", "d"), ["a", "b"], 2, ridge=0.0, delta=1.0)
    squared = fit_linear(df, F.array("a", "b"), F.array("c", "d"), ["a", "b"], 2, ridge=0.0)
    for j in range(2):
        coef, intercept = plain_huber(x, y[:, j], 1.0)
        assert np.allclose(model.coef[:, j], coef, atol=1e-4) and model.intercept[j] == pytest.approx(intercept, abs=1e-3)
    assert abs(model.intercept[0] - 2) < 0.3 < abs(squared.intercept[0] - 2)


def series(spark, with_gaps):
    rng, rows = np.random.default_rng(2), []
    for s, n in (("a", 130), ("b", 61), ("c", 9), ("d", 3)):
        for i in range(n):
            gone = with_gaps and (i % 37 == 20 or (s == "a" and i in (50, 51)))
            value = None if gone else float(rng.normal(50, 10))
            rows.append((s, T0 + dt.timedelta(hours=i + (i > 30) * 5), value, float(rng.normal(5, 2)) if i % 41 else float("nan") if with_gaps else 1.0))
    return spark.createDataFrame(rows, "s string, t timestamp_ntz, v double, w double").repartition(3)


@pytest.mark.parametrize("n_in, n_out, block", [(6, 3, 5000), (6, 3, 16), (1, 1, 7), (4, 9, 10)])
@pytest.mark.parametrize("with_gaps", [False, True])
def test_lagged_products_equal_those_of_windows(spark, n_in, n_out, block, with_gaps):
    df = series(spark, with_gaps)
    width = 1 + 2 * n_in + n_out
    got = window_products(window_blocks(df, "s", "t", ["v", "w"], "v", n_in, n_out, block_rows=block), "s", n_in, n_out).first()
    pdf, want, n = df.toPandas().sort_values(["s", "t"]), np.zeros((width, width)), 0
    for _, one in pdf.groupby("s"):
        u = one[["v", "w"]].to_numpy(float)
        for i in range(n_in - 1, len(u) - n_out):
            z = np.concatenate([[1.0], u[i - n_in + 1:i + 1].ravel(), u[i + 1:i + n_out + 1, 0]])
            if not np.isnan(z).any():
                want += np.outer(z, z)
                n += 1
    assert got.n == n and np.allclose(np.array(got.gram).reshape(width, width), want, rtol=1e-10)
    if not with_gaps:
        windows = sequences(df, "s", "t", ["v", "w"], "v", n_in, n_out)
        direct = cross_products(windows, F.flatten("x"), F.col("y"), width).first()
        assert direct.n == n and np.allclose(direct.gram, got.gram, rtol=1e-10)


def test_huber_forecaster_equals_rows_of_windows(spark):
    df = series(spark, False).withColumn("v", F.when(F.hour("t") == 3, 900.0).otherwise(F.col("v")))
    model = forecasts.fit_multistep(df, "s", "t", ["v", "w"], "v", 4, 2, 1e-3, loss="huber", delta=5.0, block_rows=20)
    windows = sequences(df, "s", "t", ["v", "w"], "v", 4, 2)
    direct = fit_huber(windows, F.flatten("x"), F.col("y"), model.model.names, 2, 1e-3, 5.0, rounds=30)
    assert np.allclose(model.model.coef, direct.coef, atol=1e-4) and np.allclose(model.model.intercept, direct.intercept, atol=1e-2)
    with pytest.raises(ValueError):
        forecasts.fit_multistep(df, "s", "t", ["v"], "v", 4, 2, loss="other")


@pytest.fixture(scope="module")
def forest(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, r)) for i, r in enumerate(rng.normal([80, 120, 30, 80, 80], [15, 20, 5, 10, 10], (700, 5)))]
    rows += [(700, 500.0, 800.0, 200.0, 450.0, 300.0), (701, 80.0, 120.0, None, 80.0, 80.0)]
    df = spark.createDataFrame(rows, "event_id int, pm25 double, pm10 double, no2 double, pm25_1h_mean double, pm25_6h_mean double").repartition(4)
    return df, iforest.fit_iforest(df, trees=12, subsample=64)


def walk(forest, tree, x):
    node = 0
    while forest.feature[tree, node] >= 0:
        node = 2 * node + 1 + int(x[forest.feature[tree, node]] > forest.threshold[tree, node])
    return forest.path[tree, node]


def test_scores_equal_a_plain_walk_of_the_trees(forest):
    """Every row, tree by tree."""
    df, f = forest
    got = {r.event_id: r.anomaly_score for r in iforest.score_iforest(df, f).collect()}
    for r in df.collect():
        x = [0.0 if v is None else v for v in r[1:]]
        depth = sum(walk(f, t, x) for t in range(len(f.feature))) / len(f.feature)
        assert got[r.event_id] == pytest.approx(-2.0 ** (-depth / f.norm) - f.offset, abs=1e-12)
    assert len(got) == 702


def known(forest, tree, node, x, inside):
    """Expected depth below a node when only some features are known."""
    f = forest.feature[tree, node]
    if f < 0:
        return forest.path[tree, node]
    left, right = 2 * node + 1, 2 * node + 2
    if f in inside:
        return known(forest, tree, right if x[f] > forest.threshold[tree, node] else left, x, inside)
    part = forest.cover[tree, left] / forest.cover[tree, node]
    return part * known(forest, tree, left, x, inside) + (1 - part) * known(forest, tree, right, x, inside)


def test_contributions_equal_the_sum_over_all_coalitions(forest):
    df, f = forest
    rows = {r.event_id: r for r in iforest.explain_iforest(df.where("event_id in (3, 77, 700, 701)"), f).collect()}
    weight = {k: 1 / (5 * len(list(itertools.combinations(range(4), k)))) for k in range(5)}
    for r in rows.values():
        x = [0.0 if r[c] is None else r[c] for c in f.columns]
        value = {s: np.mean([known(f, t, 0, x, set(s)) for t in range(len(f.feature))]) for k in range(6) for s in itertools.combinations(range(5), k)}
        assert r.baseline == pytest.approx(value[()]) and r.depth == pytest.approx(value[(0, 1, 2, 3, 4)])
        for i, part in enumerate(r.parts):
            want = sum(weight[len(s)] * (value[tuple(sorted((*s, i)))] - value[s]) for s in value if i not in s)
            assert part.feature == f.columns[i] and part.contribution == pytest.approx(want, abs=1e-9)
        assert r.baseline + sum(p.contribution for p in r.parts) == pytest.approx(r.depth)
    assert min(rows[700].parts, key=lambda p: p.contribution).contribution < -0.3


def test_boxes_hold_every_row_once(forest):
    df, f = forest
    boxes = iforest.leaf_boxes(f)
    x = df.toPandas()[f.columns].fillna(0).to_numpy()
    inside = [((r > boxes.low) & (r <= boxes.high)).all(axis=1).sum() for r in x]
    assert pd.Series(inside).eq(len(f.feature)).all()


def broken_trend(spark):
    """Slopes change at 30 % and 60 % of the time only; hinges stand at every 5 %."""
    rng, rows = np.random.default_rng(11), []
    for i in range(1200):
        t = i / 1199
        y = 40 + 30 * t - 90 * max(t - 0.3, 0) + 120 * max(t - 0.6, 0)
        rows.append((T0 + dt.timedelta(hours=i), float(y + rng.normal(0, 0.5))))
    df = spark.createDataFrame(rows, "t timestamp_ntz, pm25 double").repartition(3)
    return df, forecasts.SeasonalSpec(T0, T0 + dt.timedelta(hours=1199), (), 19, 1.0, (), 1e-6, 1.2816, 0.02, True)


def test_sparse_hinges_find_the_breaks(spark):
    df, spec = broken_trend(spark)
    model = forecasts.fit_seasonal(df, "t", spec=spec).shared
    pdf = df.toPandas().sort_values("t")
    t, y = np.arange(1200) / 1199, pdf.pm25.to_numpy()
    x = np.column_stack([t, *[np.maximum(t - i / 20, 0) for i in range(1, 20)]])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z, pen = (x - mean) / scale, np.array([0.0] + [0.02] * 19)

    def loss(w):
        return 0.5 * np.mean((y - y.mean() - z @ w) ** 2) + 0.5e-6 * w @ w + pen @ np.abs(w)

    # Brute force: proximal gradient steps with momentum.
    step, w, v, k = 1 / np.linalg.norm(z.T @ z / len(y), 2), np.zeros(20), np.zeros(20), 1.0
    for _ in range(60_000):
        g = v + step * (z.T @ (y - y.mean() - z @ v) / len(y) - 1e-6 * v)
        new = np.sign(g) * np.maximum(np.abs(g) - step * pen, 0)
        k, last = (1 + np.sqrt(1 + 4 * k * k)) / 2, k
        w, v = new, new + (last - 1) / k * (new - w)
    own = model.coef[:, 0] * scale
    assert loss(own) <= loss(w) + 1e-6 and np.allclose(x @ model.coef[:, 0], x @ (w / scale), atol=0.05)
    slopes = np.abs(model.coef[1:, 0])
    near = {5, 6, 7, 11, 12, 13}
    assert sum(slopes[i - 1] for i in near) > 0.8 * slopes.sum() and (slopes < 1e-9).sum() >= 8
    ridge = forecasts.fit_seasonal(df, "t", spec=forecasts.SeasonalSpec(spec.start, spec.end, (), 19, 1.0, (), 1e-6)).shared
    assert (np.abs(ridge.coef[1:, 0]) < 1e-9).sum() == 0


def test_intervals_grow_with_the_horizon(spark):
    df, spec = broken_trend(spark)
    for by in (None, "s"):
        rows = df.withColumn("s", F.lit("a"))
        model = forecasts.fit_seasonal(rows, "t", by=by, spec=spec)
        ahead = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h)) for h in (600, 1199, 1300, 1500, 2398)], "s string, t timestamp_ntz")
        found = forecasts.predict_seasonal(model, ahead, "t").orderBy("t").collect()
        half = [r.yhat_upper - r.yhat for r in found]
        assert half[0] == pytest.approx(half[1]) and half[1] < half[2] < half[3] < half[4]
        if by is None:
            change, sigma = np.abs(model.shared.coef[1:20, 0]).mean(), model.shared.sigma[0]
            assert half[4] == pytest.approx(1.2816 * np.sqrt(sigma ** 2 + 2 * change ** 2 * 19 / 3), rel=1e-6)
