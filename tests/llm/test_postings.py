"""Positional index and decontamination against brute force."""

import random
import re

import pytest

from hazeline.llm.postings import build_index, clean_documents, contamination, keyed, phrases_of, prepared, proximity_matches

DOC = "doc_id long, text string, id string, key int, phrase string, pos int"
ITEM = "item_id long, text string, words int"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for phrase, names in windows.items():
            for s in range(len(w) - len(phrase) + 1):
                if tuple(w[s:s + len(phrase)]) == phrase:
                    hit |= set(range(s, s + len(phrase)))
                    found |= names
        out.append((doc, len(w), len(hit), ",".join(sorted(str(i) for i in found if i is not None))))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    vocabulary = ["the", "of", "Élan", "élan", "ÜBER", "x1", "and", "no", "yes", "zz"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 7, 9])))) for i in range(12)]
    items += [(40, None), (41, ""), (None, "lonely phrase here"), (3, items[4][1])]
    docs = [(i, rnd.choice([" ", "-", "\n, "]).join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 5, 30, 60])))) for i in range(60)]
    docs += [(100 + i, f"Start {t} END!") for i, (_, t) in enumerate(items) if t] + [(7, None), (8, ""), (None, "a LONELY, phrase... here b"), (200, "the of"), (200, "the of"), (200, "other")]
    docs.append((300, "word " * 5000 + items[0][1]))
    return docs, items, spark.createDataFrame([(d, t, "x", 1, "p", 2) for d, t in docs], DOC), spark.createDataFrame([(i, t, 1) for i, t in items], ITEM)


@pytest.mark.parametrize("size", [4, 10])
def test_against_brute_force(data, size):
    docs, items, doc_rows, item_rows = data
    got = sorted(((r.id, r.n_words, r.n_hit, ",".join(r["items"])) for r in contamination(doc_rows, item_rows, size).collect()), key=str)
    assert got == plain(docs, items, size)


def test_clean_documents_stay_whole(data):
    docs, items, doc_rows, item_rows = data
    kept = clean_documents(doc_rows, item_rows, 4)
    assert kept.columns == doc_rows.columns
    hits = {(d, n) for d, n, hit, _ in plain(docs, items, 4) if hit}
    want = sorted((d for d, t in docs if (d, len(words(t))) not in hits), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 20 + "beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = keyed(docs)
    _, probed, index = prepared(rows, items, 3)
    found = {(r.id, r.width) for r in proximity_matches(index, probed, 4).collect()}
    assert {i for i, _ in found} == {1, 2} and min(w for i, w in found if i == 2) <= 2


def test_index_of_all_terms(spark):
    docs = keyed(spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string"))
    assert sorted((r.term, r.id, r.pos) for r in build_index(docs).collect()) == [("a", 1, 0), ("a", 1, 2), ("b", 1, 1)]


def test_empty_tables(spark, data):
    _, _, doc_rows, item_rows = data
    none_docs, none_items = doc_rows.limit(0), item_rows.limit(0)
    assert contamination(none_docs, item_rows).count() == 0 and phrases_of(none_items).count() == 0
    assert contamination(doc_rows, none_items).where("n_hit > 0").count() == 0
    assert clean_documents(doc_rows, none_items).count() == doc_rows.count()
