"""Toxicity classifier: held-out accuracy, the counterfactual penalty, defined cases."""

import math
import random
import zlib

import numpy as np
import pytest

from hazeline.llm import toxicity
from hazeline.llm.toxicity import Model, Rows, features_of, fit, fit_weights, scored, training_labels, without_toxic, words_of

DOC = "doc_id long, text string, score int, label string"
LABEL = "doc_id long, quality int, toxic int, text string"


def corpus(n=600, seed=1):
    """Toxic texts name a group far more often than clean ones; the insults alone decide."""
    rnd = random.Random(seed)
    fill, insults = [f"w{i}" for i in range(200)], ["vileword", "nastyword"]
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = [rnd.choice(fill) for _ in range(12)]
        if toxic:
            words.append(rnd.choice(insults))
        if rnd.random() < (0.9 if toxic else 0.05):
            words.append("muslim")
        rnd.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus()
    return spark.createDataFrame([(d, t, 1, "x") for d, t, _ in rows], DOC), spark.createDataFrame([(d, 1, y, "z") for d, _, y in rows], LABEL), rows


def test_neutral_mentions_are_not_rejected(tables):
    docs, labels, _ = tables
    texts = [f"w{i} w{i + 1} w{i + 2} muslim w{i + 3}".encode() for i in range(100)]
    plain, fair = fit(docs, labels, fairness=0.0), fit(docs, labels, fairness=20.0)
    change = [abs(math.log(m.score(t) / (1 - m.score(t))) - math.log(m.score(t.replace(b"muslim", b"christian")) / (1 - m.score(t.replace(b"muslim", b"christian")))))
              for m in (plain, fair) for t in texts[:1]]
    assert change[1] < 0.25 * change[0]
    rejected = [sum(m.score(t) >= 0.5 for t in texts) for m in (plain, fair)]
    assert rejected[0] >= 20 and rejected[1] < 0.5 * rejected[0]
    assert np.mean([fair.score(t) for t in texts]) < np.mean([plain.score(t) for t in texts])


def test_held_out_rows_are_told_apart(tables):
    docs, labels, rows = tables
    got = {r.doc_id: r for r in scored(docs, fit(docs, labels)).collect()}
    truth = {d: y for d, _, y in rows}
    out = {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert {d for d, r in got.items() if r.held_out} == out
    assert sum((got[d].score >= 0.5) == bool(truth[d]) for d in out) >= 0.95 * len(out)
    assert not out & {r.label_id for r in training_labels(labels).collect()}


def test_filter_keeps_columns(tables):
    docs, labels, rows = tables
    kept = without_toxic(docs, fit(docs, labels))
    assert kept.columns == docs.columns and 380 <= kept.count() <= 440


def test_nulls_repeats_and_empty_tables(spark, tables):
    docs, labels, rows = tables
    extra = spark.createDataFrame([(None, None, None, None), (9001, "", 1, "a"), (9001, "", 1, "a"), (9002, "vileword " * 50_000, 1, "a")], DOC)
    marks = labels.union(spark.createDataFrame([(None, None, 1, None), (9001, 1, None, "a"), (0, 1, 0, "again")], LABEL))
    model = fit(docs.union(extra), marks)
    found = {(r.doc_id, round(r.score, 9), r.held_out) for r in scored(extra, model).collect()}
    empty = model.score(b"")
    assert {(None, round(empty, 9), False)} <= found and len(found) == 3
    assert scored(docs.limit(0), model).count() == 0
    assert fit(docs, labels.limit(0)).score(b"x") == 0.0 and fit(docs.limit(0), labels).score(b"x") == 0.0
    assert fit(docs, labels.where("toxic = 1")).score(b"x") == 1.0


def test_bound_of_the_sample(tables):
    _, labels, _ = tables
    assert training_labels(labels, 50).count() == 50


def sparse(lists, width):
    return Rows(np.array([len(x) for x in lists]), np.array([f for x in lists for f in x], np.int64), width)


def test_gradient_finds_the_minimum():
    rnd = np.random.default_rng(3)
    lists = [sorted(set(rnd.integers(0, 12, 5).tolist())) for _ in range(80)]
    y = np.array([float(0 in x or rnd.random() < 0.1) for x in lists])
    pairs, swapped = np.arange(10), sparse([sorted(set(x) ^ {3, 4}) for x in lists[:10]], 12)
    x = sparse(lists, 12)
    w, b = fit_weights(x, y, pairs, swapped, 0.01, 0.5, 4000)

    def loss(w, b):
        z = x.times(w) + b
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.005 * (w @ w) + 0.5 * np.mean((swapped.times(w) + b - z[pairs]) ** 2)

    best = loss(w, b)
    assert all(best <= loss(w + rnd.normal(0, 0.01, 12), b + rnd.normal(0, 0.01)) + 1e-9 for _ in range(50))


def test_score_uses_words_and_beginnings_once():
    model = Model({b"idiot": 1.0, b"idio*": 2.0}, -1.0)
    assert features_of(words_of(b"Idiots!")) == {b"idiots", b"idio*", b"idiot*"}
    assert model.score(b"IDIOT idiot, idiots") == pytest.approx(1 / (1 + math.exp(-2)))
    assert toxicity.Model().score(b"any") == 0.0
