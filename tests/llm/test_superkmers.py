"""Repeated windows against brute force, through small buffers and buckets."""

import random

import numpy as np
import pytest

from hazeline.llm import superkmers
from hazeline.llm.superkmers import merged, minimisers, packed_runs, without_repeats

SCHEMA = "doc_id long, text string, key int, doc string, ranges string"


def plain(rows, k):
    first = {}
    split = [(d, [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w]) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - k + 1):
            if d is not None:
                p = tuple(w[i:i + k])
                first[p] = min(d, first.get(p, d))
    out = []
    for d, w in split:
        gone = {i + j for i in range(len(w) - k + 1) for j in range(k) if d is not None and first[tuple(w[i:i + k])] < d}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    out = []
    for i in rnd.sample(range(1000), 150):
        w = [rnd.choice("abcdé") + str(rnd.randrange(3)) for _ in range(rnd.choice([0, 3, 8, 40]))]
        if i % 3 == 0:
            at = rnd.randrange(len(w) + 1)
            w[at:at] = passage[rnd.randrange(10):]
        out.append((i, rnd.choice([" ", "\n", " \t"]).join(w)))
    out += [(i + 5000, t) for i, t in out[:20]] + [(9000, None), (9001, ""), (None, out[3][1]), (out[5][0], out[5][1]), (out[6][0], "other words " * 9)]
    return [*out, (9500, "same " * 3000), (9400, "same " * 50)]


def as_frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], SCHEMA)


@pytest.mark.parametrize("held", [64 << 20, 3000])
@pytest.mark.parametrize("k, m", [(4, 2), (13, 3)])
def test_against_brute_force(spark, rows, monkeypatch, held, k, m):
    monkeypatch.setattr(superkmers, "HELD", held)
    got = sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in without_repeats(as_frame(spark, rows).repartition(3), k, m).collect()), key=str)
    assert got == plain(rows, k)


@pytest.mark.parametrize("part", [1e-9, 1e9])
def test_hot_minimisers_change_no_result(spark, rows, monkeypatch, part):
    monkeypatch.setattr(superkmers, "HOT_PART", part)
    monkeypatch.setattr(superkmers, "COUNTED", 500)
    got = sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in without_repeats(as_frame(spark, rows).repartition(3), 4, 2).collect()), key=str)
    assert got == plain(rows, 4)


def test_hot_minimisers_are_found(spark):
    docs = [(i, 0, f"u{i} v{i} w{i} x{i} " + "all share this " + f"a{i} b{i} c{i} d{i}") for i in range(300)]
    hot = superkmers.hot_minimisers(spark.createDataFrame(docs, "doc long, key int, text string").repartition(2), 4, 2, 0.05)
    words = "all share this".encode().split()
    own = {int(v) for i in range(2) for v in minimisers(words[i:i + 2], 2, 2)}
    assert own & set(hot.tolist()) and set(hot.tolist()) <= own
    values = minimisers(docs[0][2].encode().split(), 4, 2, hot)
    assert not any(int(v) in own for v in values)


def test_empty_table(spark):
    assert without_repeats(as_frame(spark, [])).count() == 0


def test_equal_windows_share_a_minimiser_and_runs_cover_all():
    rnd = random.Random(1)
    words = [b"w%d" % rnd.randrange(12) for _ in range(3000)]
    values = minimisers(words, 6, 2)
    seen = {}
    for i, v in enumerate(values.tolist()):
        assert seen.setdefault(tuple(words[i:i + 6]), v) == v
    at = 0
    for text, start, windows, value in packed_runs(words, 6, 2):
        assert start == at and text.split(b" ") == words[start:start + windows + 5] and (values[start:start + windows] >> np.uint64(32) == value).all()
        at += windows
    assert at == len(values)


def test_merged():
    assert merged([(5, 9), (0, 2), (2, 3), (8, 12)]) == [0, 3, 5, 12]
