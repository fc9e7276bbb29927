"""Registered queries of the text operators over the smallest tables, against SQL or plain Python."""

import hashlib
import os
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from hazeline.llm.queries import QUERIES, SQL
from suite.check import compare, duck

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def rows_of(spark, number):
    return QUERIES[next(n for n in QUERIES if n.startswith(f"op{number}_"))](spark, FOLDER)


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER).toPandas(), con.execute(SQL[name]).df()) is None


def test_fingerprints(spark, texts):
    from test_simhash import plain_components

    rows = sorted(texts.items())
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows_of(spark, 1).collect()), key=str)
    assert got == plain_components(rows)


def test_warc(spark, con):
    got = {r.page_id: r for r in rows_of(spark, 2).collect()}
    pages = dict(con.execute("SELECT page_id, html FROM pages").fetchall())
    largest = {}
    for p, h in pages.items():
        largest[h] = max(p, largest.get(h, p))
    assert set(got) == set(pages)
    for p, h in pages.items():
        assert got[p].payload_bytes == len((h or "").encode())
        assert (got[p].record_type, got[p].refers_to) == (("response", None) if largest[h] == p else ("revisit", largest[h]))


def test_mix(spark, con):
    got = rows_of(spark, 4).collect()
    assert {r.doc_id: r.size for r in got} == dict(con.execute(r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) FROM documents").fetchall())
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(t for _, t in taken) == pytest.approx(1.5 * sum(r.size for r in got))
    assert all(abs(sum(v) - t) <= 0.02 * t + 20 for (_, t), v in taken.items())


def test_toxicity_of_held_out_rows(spark, con):
    labels = dict(con.execute("SELECT doc_id, max(toxic) FROM labels GROUP BY 1").fetchall())
    got = rows_of(spark, 5).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    own = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert sum(own) >= 0.85 * len(own)


def test_secrets(spark, texts):
    from test_secrets import plain_base

    names = ("assign", "access", "hex")
    for r in rows_of(spark, 7).collect():
        base = plain_base(texts[r.doc_id] or "")
        listed = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows_of(spark, 10).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids)) and r.over_limit == (r.n_tokens > 2048)


def test_token_files(spark, texts):
    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows_of(spark, 13).collect()}
    for doc in sorted(texts):
        ids = library.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        assert got.pop(doc) == (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    assert not got
