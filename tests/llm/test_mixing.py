"""Mixing: targets by plain resharing, dual by bisection, rounding, reruns."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hazeline.llm.mixing import mix, mixed, targets

SCHEMA = "doc_id long, text string, source string, size int, copies int, target string"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= limit * sizes[s]}
        for s in full or open_:
            out[s] = limit * sizes[s] if full else level * weight[s]
        left -= sum(limit * sizes[s] for s in full)
        open_ = open_ - full if full else set()
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    sources = ["a", "b", "Z", "é", "z", None, "hot", "hot", "hot", "hot", "tiny"]
    out = [(i, " ".join(["w"] * int(rnd.paretovariate(1.1) * 5 % 900)), rnd.choice(sources)) for i in range(900)]
    return out + [(1000, None, "a"), (1001, "", "empty"), (5, "dup dup", "hot"), (5, "dup dup", "hot"), (5, "dup dup", "hot"), (None, "no id here", None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, s, 1, 2, "x") for d, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def plan(docs):
    return mix(docs).collect()


def test_targets(spark, rows, plan):
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    got = {r.source: (r.source_size, r.target) for r in plan}
    assert {s: v for s, (v, _) in got.items()} == sizes
    assert all(got[s][1] == pytest.approx(want[s], rel=1e-12) for s in want)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_taken_words_meet_targets(rows, plan):
    assert len(plan) == len(rows)
    for source in {r.source for r in plan}:
        own = [r for r in plan if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= max(3, 0.01 * own[0].target)
    assert all(0 <= r.copies <= 2 for r in plan)


def test_rates_are_the_exponential_tilt(plan):
    """Copies of a size class follow the solution of the dual found by bisection."""
    own = [r for r in plan if r.source == "b" and r.size]
    rest = [r for r in plan if r.source == "b"]
    mean = sum(r.size for r in rest) / len(rest)

    def words(at):
        return sum(r.size * 2 / (1 + math.exp(-max(-600, min(600, at * r.size / mean)))) for r in own)

    low, high = -1e3, 1e3
    for _ in range(200):
        low, high = ((low + high) / 2, high) if words((low + high) / 2) < own[0].target else (low, (low + high) / 2)
    for small, large in ((0, mean), (mean, 1e9)):
        part = [r for r in own if small < r.size <= large]
        want = sum(r.size * 2 / (1 + math.exp(-low * r.size / mean)) for r in part)
        assert sum(r.copies * r.size for r in part) == pytest.approx(want, abs=max(r.size for r in own))


def test_reruns_agree(docs, plan):
    again = mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, plan))


def test_the_mix_repeats_rows(docs, plan):
    out = mixed(docs)
    assert out.columns == [*docs.columns, "copy"]
    got = {(r.doc_id, r.text): r.n for r in out.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    texts = {(d.doc_id, d.text): 0 for d in docs.collect()}
    keys = {(r.id, r.key): 0 for r in plan}
    for r in plan:
        keys[r.id, r.key] += r.copies
    assert sum(got.values()) == sum(keys.values()) and set(got) <= set(texts)
    assert got[5, "dup dup"] == next(n for (i, k), n in keys.items() if i == 5 and sum(1 for r in plan if (r.id, r.key) == (i, k)) == 3)


def test_empty_tables_and_sources(spark, docs):
    assert mix(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0
    assert targets(spark.createDataFrame([("a", 0), ("b", 0)], "source string, source_size long")).where("target = 0").count() == 2
