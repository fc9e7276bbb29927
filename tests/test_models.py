"""Quantiles, drift, scores, anomalies, kriging, regressions and their texts."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazeline.functions import text
from hazeline.operators import drift, faults, forecasts, iforest, metrics, quality, regression, spatial
from hazeline.operators.explain import explanation, top_contributors
from hazeline.operators.quantiles import exact_quantiles, quantiles_of_counts
from hazeline.sources.tables import default_wards

T0 = dt.datetime(2024, 6, 1)


def test_quantiles_by_ranges_are_exact(spark):
    """The form for many distinct values, with one value holding a third of the rows."""
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(50, 20, 3000).round(3), np.full(1500, 42.0)])
    pdf = pd.DataFrame({"f": ["a"] * 4500 + ["b"] * 3, "v": np.concatenate([values, [1.0, 2.0, 4.0]])})
    counts = spark.createDataFrame(pdf).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    probs = [0, 0.05, 0.25, 1 / 3, 0.5, 0.9, 1]
    for small in (0, 10**6):
        for ranges in (4, 512):
            rows = quantiles_of_counts(counts, "f", "v", "n", probs, small=small, ranges=ranges).collect()
            got = {(r["f"], r["prob_index"]): r["quantile"] for r in rows}
            assert len(rows) == 14
            for i, p in enumerate(probs):
                assert got["a", i] == pytest.approx(np.quantile(values, p), abs=1e-9)
                assert got["b", i] == pytest.approx(np.quantile([1, 2, 4], p), abs=1e-9)


def numpy_psi(b, c, n=10):
    """Independent form: bin numbers by search, shares floored at 0.001."""
    if len(set(b)) <= 2:
        edges = np.linspace(min(b.min(), c.min()), max(b.max(), c.max()), n + 1)
    else:
        edges = np.unique(np.quantile(b, np.arange(n + 1) / n))
    place = lambda v: np.clip(np.searchsorted(edges, v, side="right"), 1, len(edges) - 1)
    share = lambda v: np.maximum(np.bincount(place(v), minlength=len(edges))[1:] / len(v), 1e-3)
    return float(((share(c) - share(b)) * np.log(share(c) / share(b))).sum())


def test_psi(spark):
    rng = np.random.default_rng(2)
    base = pd.DataFrame({"same": rng.normal(60, 15, 1000), "flag": np.zeros(1000), "two": rng.integers(0, 2, 1000).astype(float), "gone": np.full(1000, np.nan)})
    cur = base.copy()
    cur["flag"], cur["two"] = 1.0, rng.integers(0, 2, 1000) * 1.0
    base["shift"], cur["shift"] = rng.normal(60, 15, 1000), rng.normal(90, 15, 1000)
    base["near"], cur["near"] = rng.choice([1.0, 2.0, 3.0], 1000, p=[0.01, 0.98, 0.01]), rng.choice([1.0, 2.0, 5.0], 1000)
    columns = list(base.columns)
    got = {r["feature"]: r["psi"] for r in drift.psi(spark.createDataFrame(base), spark.createDataFrame(cur), columns).collect()}
    assert got["gone"] == 0.0 and got["same"] < 0.01 and got["flag"] > 0.5 and got["shift"] > 0.2
    for c in ("same", "flag", "two", "shift", "near"):
        assert got[c] == pytest.approx(numpy_psi(base[c].to_numpy(), cur[c].to_numpy()), abs=1e-9), c
    top = drift.worst_feature(spark.createDataFrame([("a", 0.1), ("b", 0.4)], "feature string, psi double")).first()
    assert tuple(top) == (0.4, "b")


def test_drift_classes_and_decision(spark):
    df = spark.createDataFrame([(p,) for p in (0.10, 0.20, 0.22, 0.25, 0.26)], "p double")
    assert [r[0] for r in df.select(drift.psi_class(F.col("p"))).collect()] == ["stable", "warning", "warning", "retrain", "retrain"]
    cases = spark.createDataFrame([(0.3, False, False), (0.3, False, True), (0.25, False, False), (0.1, True, True), (0.1, None, False)], "p double, d boolean, e boolean")
    got = [r[0] for r in cases.select(drift.retrain_decision(F.col("p"), F.col("d"), F.col("e"))["should_retrain"]).collect()]
    assert got == [True, False, False, True, False]


def test_scores(spark):
    rng = np.random.default_rng(4)
    y, p = rng.uniform(0, 100, 200), rng.uniform(0, 100, 200)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}).assign(y=lambda d: d.y.where(d.index > 4)))
    df = df.withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
    r = metrics.regression_metrics(df, "y", "p").first()
    e = y[5:] - p[5:]
    assert r["n"] == 195 and r["rmse"] == pytest.approx(np.sqrt((e**2).mean())) and r["mae"] == pytest.approx(np.abs(e).mean())
    assert r["r2"] == pytest.approx(1 - (e**2).sum() / ((y[5:] - y[5:].mean()) ** 2).sum()) and r["mape"] == pytest.approx((np.abs(e) / y[5:]).mean() * 100)
    flat = metrics.regression_metrics(spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double"), "y", "p").first()
    assert flat["r2"] == 0.0
    none = metrics.regression_metrics(spark.createDataFrame([(None, 4.0)], "y double, p double"), "y", "p").first()
    assert none["rmse"] is None and none["r2"] is None


def test_blend_and_weights(spark):
    df = spark.createDataFrame([(50.0, 60.0)], "a double, b double")
    assert metrics.blend(df, "a", "b", 0.4, 0.6).first()["blend"] == pytest.approx(56.0)
    assert metrics.blend(df, "a", "b", 0.0, None).first()["blend"] == pytest.approx(56.0)
    rng = np.random.default_rng(1)
    a, b = rng.normal(50, 9, 300), rng.normal(50, 9, 300)
    y = 0.35 * a + 0.65 * b
    best = metrics.optimize_weights(spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "y": y})), "a", "b", "y").first()
    assert best["weight_a"] == pytest.approx(0.35) and best["weight_b"] == pytest.approx(0.65)


def test_degradation_and_comparison(spark):
    df = spark.createDataFrame([(0.175, 0.15), (0.16, 0.15), (0.12, 0.15), (0.2, 0.0), (0.2, None)], "cur double, base double")
    parts = metrics.degradation(F.col("cur"), F.col("base"))
    assert [r[0] for r in df.select(parts["degraded"]).collect()] == [True, False, False, False, False]
    rows = spark.createDataFrame([(12.0, 10.0), (10.0, 10.0), (None, 10.0)], "champ double, new double")
    assert [r[0] for r in rows.select(metrics.promote(F.col("champ"), F.col("new"))).collect()] == [True, False, True]
    runs = spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", 4.0)], "run string, rmse double")
    assert metrics.select_best(runs, "rmse", "run").first()["run"] == "a"


def test_quality(spark):
    rows = spark.createDataFrame(
        [("s", "openaq", 27.0, 85.0, T0, 50.0, 60.0, None, None, None, 100), (None, "other", 27.0, 95.0, T0, 1000.0, None, None, None, None, 501)],
        "station_id string, source string, lat double, lon double, timestamp_utc timestamp_ntz, pm25 double, pm10 double, no2 double, o3 double, co double, aqi_us int")
    found = {(r["column"], r["check"]): r["value"] for r in quality.failures(rows, quality.READING_RULES, []).collect()}
    assert found == {("station_id", "not_null"): None, ("source", "isin"): "other", ("lon", "in_range"): "95.0", ("pm25", "in_range"): "1000.0", ("aqi_us", "in_range"): "501"}
    valid, held = quality.validate(rows, quality.READING_RULES)
    assert valid.count() == 1 and held.count() == 1
    frozen = spark.createDataFrame([(5.0, 5.0)] * 20, "pm25_24h_mean double, pm25_lag_1h double")
    assert tuple(quality.training_gates(frozen).select("share_ok", "moving_ok").first()) == (True, False)


def test_faults(spark):
    rows = spark.createDataFrame(
        [("a", T0 + dt.timedelta(hours=i), 0.0) for i in range(5)] + [("b", T0 + dt.timedelta(hours=i), v) for i, v in enumerate([0.0, 0.0, 5.0, 0.0, None, 0.0, 1200.0])],
        "station_id string, timestamp_utc timestamp_ntz, pm25 double").repartition(3)
    out = faults.sensor_faults(rows).collect()
    stuck = sorted((r["station_id"], r["timestamp_utc"]) for r in out if r["alert_type"] == "sensor_fault_stuck_zero")
    assert [t[11:13] for _, t in stuck] == ["02", "03", "04"] and {s for s, _ in stuck} == {"a"}
    assert [(r["value"], r["anomaly_score"]) for r in out if "impossible" in r["alert_type"]] == [(1200.0, -1.0)]


def test_iforest(spark):
    rng = np.random.default_rng(3)
    train = pd.DataFrame(rng.normal([80, 120, 30, 80, 80], [15, 20, 5, 10, 10], (2000, 5)), columns=["pm25", "pm10", "no2", "pm25_1h_mean", "pm25_6h_mean"])
    df = spark.createDataFrame(train.assign(event_id=range(2000)))
    forest = iforest.fit_iforest(df, trees=60)
    again = iforest.fit_iforest(df.repartition(7), trees=60)
    assert np.array_equal(forest.feature, again.feature) and np.array_equal(forest.threshold, again.threshold)
    assert forest.offset == pytest.approx(again.offset)
    assert iforest.score_iforest(df, forest).where("is_anomaly").count() == pytest.approx(100, abs=2)
    probe = spark.createDataFrame([(500.0, 800.0, 200.0, 450.0, 300.0), (80.0, 120.0, 30.0, 80.0, 80.0)], list(train.columns))
    spike, usual = iforest.score_iforest(probe, forest).collect()
    assert spike["is_anomaly"] and not usual["is_anomaly"] and spike["anomaly_score"] < usual["anomaly_score"]
    few = iforest.tree_samples(iforest.feature_frame(df.limit(100)), iforest.ANOMALY_FEATURES, ["event_id"], 10, 256, 1)
    assert few.count() == 1000
    many = iforest.tree_samples(iforest.feature_frame(df), iforest.ANOMALY_FEATURES, ["event_id"], 10, 32, 1)
    assert {r["count"] for r in many.groupBy("tree").count().collect()} == {32}


SENSORS = [(27.7172, 85.3240, 80.0), (27.6588, 85.3247, 120.0), (27.6710, 85.4298, 95.0), (27.6783, 85.2789, 150.0), (27.7000, 85.3500, 110.0)]


def sensors(spark, rows=SENSORS, hours=2):
    return spark.createDataFrame([(h, *r) for h in range(hours) for r in rows], "h int, lat double, lon double, pm25 double")


@pytest.mark.parametrize("model", ["spherical", "exponential", "gaussian"])
def test_kriging(spark, model):
    wards = default_wards(spark)
    out = spatial.krige(sensors(spark), wards, spatial.Variogram(model, 500.0, 0.1, 0.0), "h").toPandas()
    assert len(out) == 64 and out.pm25.between(50, 200).all() and out.pm25.std() > 1 and (out.kriging_variance > -1e-6).all()
    assert set(out.station_id) == {f"ward_{i}" for i in range(1, 33)} and set(out.source) == {"kriging_interpolated"}
    here = spark.createDataFrame([(1, "x", 27.6588, 85.3247)], "ward_id int, ward_name string, lat double, lon double")
    hit = spatial.krige(sensors(spark), here, spatial.Variogram(model, 500.0, 0.1, 0.0), "h").first()
    assert hit["pm25"] == pytest.approx(120.0, abs=1e-6) and hit["kriging_variance"] == pytest.approx(0.0, abs=1e-6)
    assert spatial.krige(sensors(spark, SENSORS[:2]), wards, spatial.Variogram(), "h").count() == 0
    twice = spatial.krige(sensors(spark, SENSORS + SENSORS), wards, spatial.Variogram(model, 500.0, 0.1, 0.0), "h").toPandas()
    assert np.allclose(twice.sort_values(["h", "ward_id"]).pm25, out.sort_values(["h", "ward_id"]).pm25)


def test_semivariogram_and_fit(spark):
    rng = np.random.default_rng(8)
    places = rng.uniform(0, 0.3, (40, 2))
    rows = [(h, float(a), float(b), float(100 * a + rng.normal())) for h in range(3) for a, b in places]
    df = spark.createDataFrame(rows, "h int, lat double, lon double, pm25 double")
    got = {r["bin"]: r for r in spatial.semivariogram(df, "h", "pm25", 0.05, 8).collect()}
    sums = {}
    for h in range(3):
        part = [r for r in rows if r[0] == h]
        for i in range(40):
            for j in range(i):
                d = np.hypot(part[i][1] - part[j][1], part[i][2] - part[j][2])
                sums.setdefault(int(d / 0.05), []).append((part[i][3] - part[j][3]) ** 2 / 2)
    for k, r in got.items():
        assert r["n_pairs"] == len(sums[k]) and r["gamma"] == pytest.approx(np.mean(sums[k]))
    fit = spatial.fit_variogram(spatial.semivariogram(df, "h", "pm25", 0.05, 8))
    assert fit.sill > 0 and fit.range_ > 0 and fit.nugget >= 0


def test_linear_models(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 3))
    pdf = pd.DataFrame(x, columns=list("abc")).assign(k=["hot"] * 800 + ["cold"] * 100, y=2 + x @ [1.0, -2.0, 0.5] + rng.normal(0, 0.1, 900))
    pdf.loc[pdf.k == "cold", "y"] += 10
    df = spark.createDataFrame(pdf).repartition(6)
    columns, target = F.array("a", "b", "c"), F.array("y")
    hot = regression.fit_linear(df.where("k = 'hot'"), columns, target, ["a", "b", "c"], ridge=0.0)
    part = pdf[pdf.k == "hot"]
    want = np.linalg.lstsq(np.column_stack([np.ones(800), part[["a", "b", "c"]]]), part.y, rcond=None)[0]
    assert np.allclose(np.r_[hot.intercept, hot.coef[:, 0]], want, atol=1e-6) and hot.sigma[0] == pytest.approx(0.1, abs=0.02)
    per = {r["k"]: r for r in regression.fit_linear_by(df, columns, target, ["a", "b", "c"], "k", ridge=0.0).collect()}
    assert per["hot"]["n"] == 800 and per["hot"]["intercept"] == pytest.approx(want[0]) and per["cold"]["intercept"] == pytest.approx(12, abs=0.1)
    shown = df.where("k = 'hot'").select("y", regression.predict(hot, columns).alias("p")).toPandas()
    assert np.abs(shown.y - shown.p).max() < 1
    terms = {c: (float(hot.coef[i, 0]), float(hot.mean[i])) for i, c in enumerate("abc")}
    total = regression.contributions(df.where("k = 'hot'").withColumn("id", F.monotonically_increasing_id()), ["id", "y"], terms).groupBy("id", "y").agg(F.sum("contribution").alias("s")).toPandas()
    assert np.abs(total.y - total.s - part.y.mean()).max() < 1


def training_rows(spark, n=300, stations=("a", "b")):
    rng = np.random.default_rng(1)
    rows = [(s, T0 + dt.timedelta(hours=h), float(max(60 + 30 * np.sin(2 * np.pi * (h - 8) / 24) + rng.normal(0, 8), 5)), float(rng.uniform(5, 30)), h % 2 == 0)
            for s in stations for h in range(n)]
    return spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, pm25 double, temp_c double, is_monsoon boolean")


@pytest.mark.parametrize("by", [None, "station_id"])
def test_seasonal_forecast(spark, by):
    rows = training_rows(spark)
    model = forecasts.fit_seasonal(rows, "ts", by=by)
    fitted = forecasts.predict_seasonal(model, rows, "ts").toPandas()
    assert np.sqrt(((fitted.pm25 - fitted.yhat) ** 2).mean()) < 10
    future = forecasts.predict_seasonal(model, forecasts.future_hours(rows, "station_id", "ts"), "ts").toPandas()
    assert len(future) == 48 and future.yhat.notna().all() and (future.yhat_lower <= future.yhat).all() and (future.yhat <= future.yhat_upper).all()


def test_multistep_forecast(spark):
    from hazeline.operators.windows import sequences

    rows = training_rows(spark, 200)
    model = forecasts.fit_multistep(rows, "station_id", "ts", ["pm25", "temp_c"], "pm25")
    windows = sequences(rows, "station_id", "ts", ["pm25", "temp_c"], "pm25")
    assert windows.count() == 2 * (200 - 48 - 24 + 1)
    out = forecasts.predict_multistep(model, windows, ["station_id", "ts", "y"])
    pdf = out.withColumn("actual", F.element_at("y", F.col("horizon"))).toPandas()
    assert set(pdf.horizon) == set(range(1, 25)) and np.sqrt(((pdf.actual - pdf.forecast) ** 2).mean()) < 15


def test_closed_form_interval(spark):
    snapshot = spark.createDataFrame([("s", None), ("z", 0.0)], "station_id string, pm25 double")
    points = forecasts.forecast_all(snapshot, "station_id", "pm25", F.lit(dt.datetime(2026, 5, 17, 3))).toPandas()
    assert len(points) == 48 and points.pm25_predicted.between(0, 500).all()
    assert np.allclose((points.confidence_upper - points.pm25_predicted), 14.70, atol=0.011)
    assert (points.confidence_lower <= points.pm25_predicted).all() and set(points.aqi_category) <= {"Good", "Moderate", "USG", "Unhealthy", "Very Unhealthy", "Hazardous"}
    with pytest.raises(ValueError):
        forecasts.forecast_all(snapshot, "station_id", "pm25", F.current_timestamp(), 73)


def test_explanations(spark):
    df = spark.createDataFrame([(1, 80.0, [("odd_name", -3.0), ("is_tihar", 18.34), ("temp_c", 0.4)]), (2, 50.0, [("temp_c", 0.1)])],
                               "id int, p double, parts array<struct<feature string, contribution double>>")
    said = {r[0]: r[1] for r in df.select("id", explanation(F.col("parts"), F.col("p"))).collect()}
    assert said[1] == "Predicted PM2.5: 80.0 µg/m³. Key drivers: Tihar festival fireworks increased PM2.5 by 18.3 µg/m³; odd name decreased PM2.5 by 3.0 µg/m³."
    assert said[2] == "Current PM2.5 prediction: 50.0 µg/m³ (no dominant single factor)"
    top = top_contributors(df, ["id"], "parts", 2).where("id = 1").collect()
    assert [(r["rank"], r["feature"], r["direction"]) for r in top] == [(1, "is_tihar", "increases"), (2, "odd_name", "decreases")]


def test_fixed_text_equals_printf(spark):
    rng = np.random.default_rng(0)
    values = [99.25, 99.75, 1234567.0, -0.04, 0.0, 11.235, 2.675, 1.005, 0.15, 0.25, 0.35, 8.125, -2.5, 0.999, 9.995]
    values += [float(v) for v in (rng.integers(0, 10**6, 3000) / 1000)] + [float(v) for v in rng.normal(0, 100, 1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in (1, 2, 3):
        got = {r[0]: r[1] for r in df.select("i", text.fixed(F.col("v"), digits)).collect()}
        assert [(v, got[i]) for i, v in enumerate(values) if got[i] != f"{v:.{digits}f}"] == []
