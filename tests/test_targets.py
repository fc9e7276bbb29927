"""Any number of targets, in blocks; cell-wise semivariogram against all pairs."""

import numpy as np
import pytest

from hazeline.operators.spatial import Variogram, krige, semivariogram, with_targets


def test_more_targets_than_a_block_holds(spark):
    rows = spark.createDataFrame([(1, 27.7, 85.3, 10.0), (1, 27.8, 85.4, 30.0), (1, 27.6, 85.2, 20.0), (2, 27.7, 85.3, 5.0)], "hour int, lat double, lon double, pm25 double")
    goals = spark.range(5000).selectExpr("cast(id as int) as ward_id", "concat('w', id) as ward_name", "27.6 + id * 0.00004 as lat", "85.2 + id * 0.00004 as lon")
    found = krige(rows, goals, Variogram("exponential", 10.0, 0.5, 1.0), "hour").select("ward_id", "pm25").collect()
    assert len(found) == 5000 and len({r.ward_id for r in found}) == 5000
    whole = {r.ward_id: r.pm25 for r in krige(rows, goals, Variogram("exponential", 10.0, 0.5, 1.0), "hour", size=10_000).collect()}
    assert all(r.pm25 == pytest.approx(whole[r.ward_id]) for r in found)
    assert with_targets(rows, goals).count() == 20_000
    assert krige(rows, goals.limit(0), Variogram(), "hour").count() == 0 and with_targets(rows, goals.limit(0)).count() == 0


def test_cells_find_all_near_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 3)), float(a), float(b), float(rng.normal())) for a, b in np.round(rng.uniform(-0.3, 0.3, (150, 2)), 3)]
    got = {r.bin: r for r in semivariogram(spark.createDataFrame(rows, "m int, lat double, lon double, v double"), "m", "v", 0.02, 6).collect()}
    place = {}
    for m, a, b, v in rows:
        place.setdefault((m, a, b), []).append(v)
    points = [(*k, float(np.mean(v))) for k, v in place.items()]
    want = {}
    for i, (m, a, b, v) in enumerate(points):
        for n, c, d, w in points[:i]:
            dist = float(np.hypot(a - c, b - d))
            k = int(np.floor(dist / 0.02 + 1e-9))
            if m == n and k < 6:
                want.setdefault(k, []).append((dist, (v - w) ** 2))
    assert set(got) == set(want)
    for k, pairs in want.items():
        assert got[k].n_pairs == len(pairs) and got[k].gamma == pytest.approx(np.mean([s for _, s in pairs]) / 2) and got[k].distance == pytest.approx(np.mean([d for d, _ in pairs]))
