"""Contributions add up to the prediction; stations without a model get the closed form."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.operators import forecasts
from hazeline.plans.jobs import publish_model_forecasts

T0 = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(s, T0 + dt.timedelta(hours=i), 40.0 + 10 * (i % 24 > 12) + i * 0.01 + k, float(i % 7)) for i in range(200) for k, s in enumerate("ab")]
    return spark.createDataFrame(data, "station_id string, timestamp_utc timestamp_ntz, pm25 double, temp_c double")


@pytest.mark.parametrize("by", [None, "station_id"])
def test_contributions_add_up(rows, by):
    spec = forecasts.seasonal_spec(rows, "timestamp_utc", hinges=2, seasons=((1.0, 2),), regressors=("temp_c",))
    model = forecasts.fit_seasonal(rows, "timestamp_utc", by=by, spec=spec)
    parts = forecasts.seasonal_contributions(model, rows, "timestamp_utc")
    whole = parts.select("station_id", "timestamp_utc", (F.col("baseline") + F.aggregate(F.transform("parts", lambda p: p["contribution"]), F.lit(0.0), lambda a, b: a + b)).alias("sum"))
    both = forecasts.predict_seasonal(model, rows, "timestamp_utc").join(whole, ["station_id", "timestamp_utc"]).collect()
    assert len(both) == 400 and all(r["sum"] == pytest.approx(r["yhat"], abs=1e-6) for r in both)


def test_fallback_without_a_model(rows):
    spec = forecasts.seasonal_spec(rows, "timestamp_utc", hinges=0, seasons=((1.0, 2),), regressors=())
    model = forecasts.fit_seasonal(rows.where("station_id = 'a'"), "timestamp_utc", by="station_id", spec=spec)
    found = publish_model_forecasts(rows, model, 12).collect()
    assert len(found) == 24 and {(r.station_id, r.model_used) for r in found} == {("a", "seasonal_regression"), ("b", "fallback_diurnal")}
    assert all(0 <= r.confidence_lower <= r.pm25_predicted <= r.confidence_upper <= 1000 for r in found)
