"""Models per key: sums Spark adds itself, narrow and wide, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators import regression


@pytest.mark.parametrize("p", [2, regression.NARROW + 3])
def test_products_per_key_need_no_python_group(spark, p):
    rng = np.random.default_rng(p)
    x, keys = rng.normal(size=(240, p)), np.array(["a", "b", None, "one"] * 60, object)
    keys[keys == "one"] = ["one"] + ["a"] * 59
    y = x.sum(axis=1) + rng.normal(size=240)
    rows = [(k, [*map(float, r)], None if i == 5 else float(v)) for i, (k, r, v) in enumerate(zip(keys, x, y))]
    df = spark.createDataFrame(rows, "k string, x array<double>, y double").repartition(3)
    grams = regression.cross_products(df, F.col("x"), F.array("y"), p + 2, ["k"])
    assert "Pandas" not in grams._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: (r.n, np.array(r.gram).reshape(p + 2, p + 2)) for r in grams.collect()}
    assert set(got) == {"a", "b", None, "one"}
    fits = {r.k: r for r in regression.fit_linear_by(df, F.col("x"), F.array("y"), [f"x{i}" for i in range(p)], "k", 0.1).collect()}
    for k, (n, gram) in got.items():
        mine = np.array([q == k for q in keys]) & (np.arange(240) != 5)
        v = np.column_stack([np.ones(mine.sum()), x[mine], y[mine]])
        assert n == len(v) and np.allclose(gram, v.T @ v)
        coef, intercept, _, sigma, _ = regression.solve(v.T @ v, p, 1, 0.1)
        assert np.allclose(fits[k].coef, coef[:, 0]) and np.allclose([fits[k].intercept, fits[k].sigma], [intercept[0], sigma[0]], atol=1e-6)
    assert regression.fit_linear_by(df.limit(0), F.col("x"), F.array("y"), [f"x{i}" for i in range(p)], "k").count() == 0


def test_station_trends_are_summed_by_spark(spark):
    """The straight line per station that model forecasts are published from."""
    import datetime as dt

    from hazeline.operators import forecasts

    start = dt.datetime(2024, 1, 1)
    rows = [(f"s{i}", start + dt.timedelta(hours=h), 10.0 + i + 2 * h) for i in range(30) for h in range(4)]
    df = spark.createDataFrame(rows, "station_id string, timestamp_utc timestamp_ntz, pm25 double").repartition(3)
    spec = forecasts.seasonal_spec(df, "timestamp_utc", hinges=0, seasons=(), regressors=(), ridge=0.0)
    model = forecasts.fit_seasonal(df, "timestamp_utc", by="station_id", spec=spec)
    assert "FlatMapGroups" not in model.per_key._jdf.queryExecution().optimizedPlan().toString()
    ahead = forecasts.predict_seasonal(model, forecasts.future_hours(df, "station_id", "timestamp_utc", 2), "timestamp_utc").collect()
    assert {(r.station_id, r.horizon, round(r.yhat, 4)) for r in ahead} == {(f"s{i}", h, 10.0 + i + 2 * (3 + h)) for i in range(30) for h in (1, 2)}
