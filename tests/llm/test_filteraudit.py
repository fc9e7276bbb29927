"""The filter audit against a plain walk through all orders, and the duplicate prepass against plain counts."""

import random
import re
from itertools import permutations

import pytest

from hazeline.llm import filteraudit
from hazeline.llm.filteraudit import facts_of, filter_audit, mask_counts, possible_repeats

METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
DOCS = "doc_id long, text string, source string, mask int, h string, Digest string"
LABELS = "doc_id long, quality int, toxic int"


def plain_failures(rows, labels):
    """(part, failed letters, good, toxic) of each row."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    out = []
    for doc, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                  "D": bool(re.search("[#$%&*|]", text)), "E": doc is not None and first[text] < doc}
        marks = [(q, t) for d, q, t in labels if d == doc and doc is not None]
        out.append((source or "", {k for k, v in failed.items() if v}, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    return out


def plain_audit(rows, labels):
    judged, found = plain_failures(rows, labels), {}
    for part in {p for p, *_ in judged}:
        mine, shares = [j for j in judged if j[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                out = [j for j in left if f in j[1]]
                gone = sum(f in j[1] for j in mine) - len(out)
                left = [j for j in left if f not in j[1]]
                shares[f] += len(out)
                found[part, "".join(order), step] = [len(left), len(out), gone, sum(j[1] == {f} for j in mine), sum(j[2] for j in out), sum(j[3] for j in out)]
        for key in found:
            if key[0] == part:
                found[key].append(shares[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in found.items()}


def corpus(seed=1):
    rnd = random.Random(seed)

    def text():
        words = [rnd.choice(["alpha", "Beta", "gamma", "delta", "x1", "é"]) + (str(rnd.randrange(400)) if rnd.random() < 0.7 else "") for _ in range(rnd.choice([0, 1, 150, 199, 200, 230]))]
        return rnd.choice([" ", "\n", "\x1f", " \t"]).join(words) + rnd.choice(["", "", " #", " A" * 30])

    texts = [text() for _ in range(60)]
    rows = [(i if rnd.random() < 0.95 else None, rnd.choice(texts + [None, "", "once more " * 120]), rnd.choice(["web", "Books", None, ""])) for i in range(300)]
    rows += [rows[5]] * 3 + [(7, "another text under an id seen before", "web"), (1000, "long " * 50_000 + "Tail|", "web")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("per_row, segment", [(16, 1 << 16), (0.01, 1 << 16), (2000, 1 << 16)])
def test_all_orders(spark, monkeypatch, per_row, segment):
    """Whatever the filter's load, from several segments of few texts to one in which every counter is full."""
    monkeypatch.setattr(filteraudit, "PER_ROW", per_row)
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, 9, "x", "y") for r in rows], DOCS).repartition(5)
    got = filter_audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[m] for m in METRICS) for r in got} == plain_audit(rows, labels)
    assert len(got) == 600 * 3


def test_prepass_clears_unique_texts_and_no_repeat(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "PIECE", 1000)
    rnd = random.Random(9)
    texts = [f"text {i} {rnd.random()}" for i in range(20_000)]
    rows = [(i, t, "s") for i, t in enumerate(texts + rnd.choices(texts[:500], k=3000) + ["hot"] * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    facts = facts_of(docs, spark.createDataFrame([], LABELS), "doc_id", "text", "source").cache()
    possible = {r.id for r in possible_repeats(facts).collect()}
    copies = {}
    for i, t, _ in rows:
        copies.setdefault(t, []).append(i)
    repeated = {i for ids in copies.values() if len(ids) > 1 for i in ids}
    assert repeated <= possible
    assert len(possible - repeated) < 0.05 * (len(rows) - len(repeated))
    found = mask_counts(docs, spark.createDataFrame([], LABELS)).collect()
    assert sum(r.n for r in found if r.mask & 16) == sum(len(v) - 1 for v in copies.values()) and sum(r.n for r in found) == len(rows)


def test_empty_table(spark):
    assert filter_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
