"""Exact top-k against brute force, with ties, odd vectors and small blocks."""

import math
import random

import numpy as np
import pytest

from hazeline.llm.topk import exact_dot, search_shard, top_k

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def plain(rows, k):
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in whole:
        if i % 100 == 0:
            asked[i] = min(v, asked.get(i, v))
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    out = [(i, [rnd.gauss(0, 0.3) for _ in range(6)]) for i in range(700)]
    out += [(1000 + i, [0.25, 0.5, -0.25, 0.0, 0.1, 0.2]) for i in range(90)]
    out += [(2000, None), (2100, [None, 1.0, 0.0, 0.0, 0.0, 0.0]), (2200, [float("nan")] * 6), (2300, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
            (2400, [0.5, 0.5]), (300, [0.9] * 6), (17, [0.1] * 6), (2500, [])]
    return out


@pytest.mark.parametrize("block, shard, group", [(4, 3, 2), (64, 128, 256)])
def test_against_brute_force(spark, rows, block, shard, group):
    table = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in top_k(table, table.where("vec_id % 100 = 0"), 10, block=block, shard=shard, group=group).collect())
    assert got == plain(rows, 10)


def test_few_candidates_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.5]), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    asked = table.where("vec_id = 0")
    assert [tuple(r) for r in top_k(table, asked).orderBy("rank").collect()] == [(0, 1, 1, 1024 * 1024 + 2048 * 512), (0, 2, 2, 0)]
    assert top_k(table.limit(0), asked).count() == 0 and top_k(table, table.limit(0)).count() == 0


def test_blocks_below_the_bound_are_not_scored():
    rnd = np.random.default_rng(1)
    rows = np.floor(rnd.normal(0, 100, (640, 8)))
    rows[:64] += 4000
    found, scored = search_shard(np.array([-1]), np.full((1, 8), 10.0), np.arange(640), rows, 10, 64)
    assert scored == 1 and len(found) == 10 and all(i < 64 for _, i, _ in found)


def test_scores_beyond_doubles_are_exact():
    a = np.array([[2.0 ** 30 + 1, 3.0]])
    assert exact_dot(a, a)[0, 0] == (2 ** 30 + 1) ** 2 + 9
