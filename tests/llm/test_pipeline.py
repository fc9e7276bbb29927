"""The corpus pipeline stage by stage on planted rows."""

import random

import pytest

import corpus_pipeline
from hazeline.llm.simhash import fingerprint
from hazeline.session import stored
from test_simhash import plain_components

INSULTS = ["vileword", "nastyword"]
SECRET = "password=hunter2hunter2"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd, path = random.Random(6), str(tmp_path_factory.mktemp("sf"))
    fill = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(300):
        words = [rnd.choice(fill) for _ in range(40)]
        if i % 5 == 0:
            words[7] = rnd.choice(INSULTS)
        if i % 7 == 1:
            words[9:9] = SECRET.split(" ")
        docs.append((i, " ".join(words), "en", f"src{i % 4}", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    item = " ".join(rnd.choice(fill) for _ in range(15))
    docs += [(1001, docs[1][1], "en", "src0", 0), (1002, docs[1][1] + " !", "en", "src1", 0), (1003, "before " + item + " after", "en", "src2", 0), (1004, None, None, None, None), (1005, None, None, None, None)]
    # A near copy: one word more, which leaves two bits of the fingerprint changed at most.
    near = next(t for t in (f"{docs[2][1]} {w}" for w in fill) if bin((fingerprint(t.encode()) ^ fingerprint(docs[2][1].encode())) & (1 << 64) - 1).count("1") <= 2)
    docs.append((1012, near, "en", "src2", 0))
    frames = {"documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
              "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "benchmark": spark.createDataFrame([(1, item)], "item_id long, text string")}
    for name, frame in frames.items():
        frame.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    out, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, folder), f"test-{name}")
        out[name] = (before, docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").distinct().collect())


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert after.columns == before.columns + (["copy"] if name == "mixing" else [])


def test_toxic_documents_go_and_others_stay(stages):
    before, after = map(ids, stages["toxicity"])
    gone = set(before) - set(after)
    assert gone <= {i for i in before if i < 1000 and i % 5 == 0} and len(gone) >= 55


def test_one_document_of_each_group_stays(stages):
    """Groups by fingerprints of three-word shingles at two bits or fewer, from plain Python."""
    before, after = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    groups = {}
    for doc, _, component in plain_components(rows):
        groups.setdefault(component, []).append(doc)
    assert ids(after) == sorted(min(g) for g in groups.values())
    assert {1001, 1005, 1012} <= set(ids(before)) - set(ids(after)) and {1, 2, 1004} <= set(ids(after))


def test_benchmark_passages_go(stages):
    before, after = map(ids, stages["decontamination"])
    assert set(before) - set(after) == {1003}


def test_secrets_are_masked_and_nothing_is_lost(stages):
    before, after = stages["secrets"]
    assert ids(before) == ids(after)
    rows = after.collect()
    assert not any(SECRET in (r.text or "") for r in rows) and sum("[assign]" in (r.text or "") for r in rows) >= 30
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_the_mix_meets_its_target(stages):
    before, after = stages["mixing"]
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.02)


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLASHING = ["copy", "mix_key", "mix_turn", "text_key", "hit_id", "hit_key", "simhash_key", "simhash_id", "simhash_key_kept", "component_id", "fingerprint", "score", "Key"]


def test_columns_of_any_name_long_texts_and_repeated_rows(spark, folder, tmp_path):
    """Through all stages: clashing names keep their values, a long text and a repeated row pass, NULL ids too."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    # The words of a clean document in another order, so that it passes the classifier and is like no other text.
    rnd, words = random.Random(1), [w for w in docs.where("doc_id = 1").first().text.split() if w != SECRET]
    long = " ".join(rnd.choices(words, k=80_000)) + " " + SECRET
    more = spark.createDataFrame([(70, long, "en", "src1", 0), (70, long, "en", "src1", 0), (None, "words without an id", "en", "src1", 0), (71, "", "en", None, 0)], docs.schema)
    wide = docs.union(more)
    for name in CLASHING:
        wide = wide.selectExpr("*", f"concat('own ', doc_id) as {name}")
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    stages = dict(corpus_pipeline.STAGES)
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in list(stages.items())[:-1]:
        out = stored(stage(spark, out, str(tmp_path)), f"wide-{name}")
        assert out.columns == wide.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == out.count() and {None, 70} <= set(rows)
    assert rows[70].text.endswith("[assign]") and len(rows[70].text) > 500_000
    mix = stages["mixing"](spark, out, str(tmp_path))
    assert mix.columns[:len(wide.columns)] == wide.columns and len(mix.columns) == len(wide.columns) + 1
    assert all(r[name] == (None if r.doc_id is None else f"own {r.doc_id}") for r in [*rows.values(), *mix.collect()] for name in CLASHING)
