"""SimHash near-duplicates against brute force on small texts."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from hazeline.llm.common import components
from hazeline.llm.simhash import fingerprint, fingerprints, masks, near_duplicates, one_per_group

SCHEMA = "doc_id long, text string, key string, root int"


def plain_fingerprint(text):
    words = []
    for run in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" "):
        if run:
            words.append(run)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted(((d, prints[i], least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = ["Ala", "bébé", "ce", "dom", "El", "fa", " x", "gé"]
    out = [(1, None), (2, ""), (3, "\t \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two"), (7, "one two"), (None, "one two"), (None, "lone text here")]
    for i in range(120):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 4, 9, 60]))]
        out.append((100 + 3 * i, " ".join(base)))
        if i % 3 == 0:
            out.append((101 + 3 * i, "\n".join(base).upper() if i % 2 else " ".join(base + ["tail"])))
    return out


def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], SCHEMA)
    got = [(r.id, r.fingerprint % (1 << 64), r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=str) == plain_components(rows)


def test_one_row_stays_per_component(spark, rows):
    docs = spark.createDataFrame([(d, t, "k", 1) for d, t in rows], SCHEMA)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in plain_components(rows)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(docs).count() == 0 and one_per_group(docs).count() == 0


def test_long_text_in_steps():
    text = b" ".join(b"w%d" % (i % 977) for i in range(70_000))
    assert fingerprint(text) % (1 << 64) == plain_fingerprint(text.decode())


def test_ball_size():
    assert len(masks(1)) == 65 and len(masks(2)) == 65 + 64 * 63 // 2


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + hub + hub[:5] + [(5000, 5000)], "a long, b long")
    sizes = components(edges).groupBy("root").agg(F.count("*").alias("n"), F.countDistinct("node").alias("d")).collect()
    assert sorted((r.n, r.d) for r in sizes) == [(200, 200), (301, 301)]


def test_a_batch_is_not_held_as_python_texts(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    docs, taken = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, rows, schema: taken.append(rows) or self)
    fingerprints(docs)
    texts = [f"{'x' * 4000} {i}" for i in range(2000)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["id", "key", "text"])
    tracemalloc.start()
    found = [v for out in taken[0](iter([batch])) for v in out.column(2).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [fingerprint((t or "").encode()) for t in texts]
    assert peak < 3_000_000 < batch.nbytes
