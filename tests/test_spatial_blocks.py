"""Kriging from nearest places and variogram pairs of crowded cells."""

import numpy as np
import pytest

from hazeline.operators import spatial
from hazeline.operators.spatial import Variogram, krige, semivariogram

SENSORS = "h int, lat double, lon double, pm25 double"
WARDS = "ward_id int, ward_name string, lat double, lon double"
VARIOGRAM = Variogram("spherical", 40.0, 0.2, 2.0)


def places(spark, n, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    rows = [(0, float(27 + a * spread), float(85 + b * spread), float(60 + 30 * np.sin(6 * a) + v)) for a, b, v in rng.random((n, 3))]
    return spark.createDataFrame(rows, SENSORS).repartition(4), rows


def wards(spark, n=12):
    rng = np.random.default_rng(9)
    return spark.createDataFrame([(i, f"w{i}", float(27 + a), float(85 + b)) for i, (a, b) in enumerate(rng.random((n, 2)))], WARDS)


def found(df):
    return df.orderBy("ward_id").toPandas()[["ward_id", "pm25", "kriging_variance"]].to_numpy()


def test_all_places_as_neighbours_equal_full_kriging(spark):
    df, _ = places(spark, 40)
    full = found(krige(df, wards(spark), VARIOGRAM, "h"))
    for k in (40, 500):
        assert np.allclose(found(krige(df, wards(spark), VARIOGRAM, "h", neighbours=k)), full)
    near = found(krige(df, wards(spark), VARIOGRAM, "h", neighbours=15))
    assert np.isfinite(near).all() and not np.allclose(near, full)


def test_nearest_places_are_those_of_a_plain_search(spark):
    df, rows = places(spark, 60, 4)
    got = found(krige(df, wards(spark), VARIOGRAM, "h", neighbours=5, size=3))
    for (_, value, variance), w in zip(got, wards(spark).orderBy("ward_id").collect()):
        near = sorted(rows, key=lambda r: np.hypot(r[1] - w.lat, r[2] - w.lon))[:5]
        xy, z = np.array([[r[2], r[1]] for r in near]), np.array([r[3] for r in near])
        one = spatial.krige_all(xy, z, np.array([[w.lon, w.lat]]), VARIOGRAM)
        assert value == pytest.approx(one[0][0]) and variance == pytest.approx(one[1][0])


def test_twenty_thousand_places_in_one_moment(spark):
    """A full system would need 3.2 GB; tables here stay below 32 MB."""
    df, rows = places(spark, 20_000, 2)
    got = found(krige(df, wards(spark), VARIOGRAM, "h", neighbours=24))
    truth = [60 + 30 * np.sin(6 * (w.lat - 27)) + 0.5 for w in wards(spark).orderBy("ward_id").collect()]
    assert np.abs(got[:, 1] - truth).max() < 2


@pytest.mark.parametrize("limit", [2000, 40, 7])
def test_crowded_cells_are_split(spark, monkeypatch, limit):
    """All places in one cell, and spread over several; every pair counts once whatever the blocks."""
    monkeypatch.setattr(spatial, "CELL_PLACES", limit)
    for spread in (0.05, 2.0):
        df, rows = places(spark, 150, 3, spread)
        got = {r.bin: (r.n_pairs, r.gamma) for r in semivariogram(df, "h", "pm25", 0.03, 10).collect()}
        want = {}
        for i, a in enumerate(rows):
            for b in rows[i + 1:]:
                k = int(np.floor(np.hypot(a[1] - b[1], a[2] - b[2]) / 0.03 + 1e-9))
                if k < 10:
                    n, s = want.get(k, (0, 0.0))
                    want[k] = (n + 1, s + (a[3] - b[3]) ** 2)
        assert set(got) == set(want)
        assert all(got[k][0] == n and got[k][1] == pytest.approx(s / n / 2) for k, (n, s) in want.items())
