"""Token files against the library of the vocabulary, and what their metadata leaves out."""

import random
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hazeline.llm import tokenfiles
from hazeline.llm.tokenfiles import Encoder, checksums, find, part_starts, read_tokens, starts, tokens_between, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN, LIBRARY = Encoder(PATH), Tokenizer.from_file(PATH)


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(encoder, text):
    return np.frombuffer(encoder.ids([text.encode()])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(
    ["<|endoftext|>", "<|startoftext|", "don't", "'s", " I'LL", "ΟΔΟΣ", "İ", "é", "\u0301", "J\u030c", "H\u0331x", "<|ENDOFTEXT|>", "12½", " ", "\n\t", "\x1c", "　", "中文", "thing", "thing.", "é,", "a'b!", "x?!", "d'.", "ñ;", "×.", "ß!", "Ȁ,", "♪", "a♪b", "§"]), max_size=12).map("".join)))
def test_runs_are_encoded_as_the_library_does(text):
    assert own_ids(OWN, text) == plain_ids(text)


def test_slices_and_renewed_runs(monkeypatch):
    monkeypatch.setattr(tokenfiles, "SLICE", 100)
    monkeypatch.setattr(tokenfiles, "KEPT", 30)
    rnd = random.Random(3)
    text = " ".join("".join(rnd.choices("abcdé's", k=rnd.randint(1, 9))) for _ in range(2000)) + "x" * 500
    encoder = Encoder(PATH)
    assert encoder.by_runs and own_ids(encoder, text) == plain_ids(text)


def test_words_go_straight_to_the_model(monkeypatch):
    encoder, rnd = Encoder(PATH), random.Random(5)
    letters = "".join(map(chr, encoder.letters))
    assert set("azAZéÖßñœ") <= set(letters) and not set("İ'1\u0301×") & set(letters)
    words = ["".join(rnd.choices(letters, k=rnd.randint(1, 12))) + "".join(rnd.choices(tokenfiles.SIGNS, k=rnd.randint(0, tokenfiles.TAIL))) for _ in range(20_000)]
    words += [w + m for w in letters for m in ("", "a", ".", "***")]
    whole, sent = encoder.encoded_runs, []
    monkeypatch.setattr(encoder, "encoded_runs", lambda runs: sent.extend(runs) or whole(runs))
    assert own_ids(encoder, " ".join(words)) == plain_ids(" ".join(words)) and not sent
    odd = ["don't", "it'S", "x12", "ñ\u0301a", "İa", "aσς", "中a", "a*b", "'re", "a'", "a.'s", "e!?.,;", "12."]
    assert own_ids(encoder, " ".join(odd)) == plain_ids(" ".join(odd)) and set(sent) == {o.encode() for o in odd}


def test_signs_stay_where_the_vocabulary_joins_them(monkeypatch):
    encoder = Encoder(PATH)
    monkeypatch.setattr(encoder, "pieces", lambda text: [text])
    assert encoder.tail_ids("!") is None and encoder.letter_table() == {}
    assert own_ids(encoder, "thing! thing") == plain_ids("thing! thing")


def test_words_kept_from_before_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(tokenfiles, "KEPT", 4)
    encoder, calls = Encoder(PATH), []
    model = encoder.word_ids
    monkeypatch.setattr(encoder, "word_ids", lambda piece: calls.append(piece) or model(piece))
    for text in ("aa bb.", "cc, dd!", "bb? ee", "BB: aa"):
        assert own_ids(encoder, text) == plain_ids(text)
    assert len(calls) == len(set(calls)) == 5


def test_runs_of_a_text_are_no_python_objects():
    encoder, text = Encoder(PATH), b"Some words, and 12 numbers. " * 40_000
    encoder.ids([text])
    tracemalloc.start()
    ids = encoder.ids([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids[0] == encoder.encoded([text[:28]])[0] * 40_000 and peak < 4 * len(text)


def test_texts_of_a_slice():
    texts = ["", " ", "a", "\t b  c.\n", "!!!", "x!?!?!", "12 thing's", "<|endoftext|>", "é. É! ñ\u0301", "\x00a\x1cb.", "'"]
    for some in (texts, texts[:2], texts[7:8], []):
        assert [np.frombuffer(v, "<u4").tolist() for v in Encoder(PATH).ids([t.encode() for t in some])] == [plain_ids(t) for t in some]


def test_vocabularies_that_keep_space_encode_whole_texts():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    text = "two  words\n\n and  a 'tail' "
    assert not encoder.by_runs
    assert own_ids(encoder, text) == Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def expected(rows):
    """(doc_id, start, n_tokens, crc, ids) of rows in id order, NULL first."""
    out, start = [], 0
    for doc, text in rows:
        ids = plain_ids(text) + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    rows = [(i * 3, " ".join(rnd.choices(["a", "Bee", "c'est", "délta", "x1"], k=rnd.randint(0, 30)))) for i in range(3000)]
    rows += [(None, None), (7, ""), (8, "word " * 60_000)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, part int, at string").repartition(5)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0])), write_tokens(docs, PATH, 1)


def test_read_back(spark, corpus):
    rows, path = corpus
    want = expected(rows)
    files = starts(read_tokens(spark, path), path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, list(r.ids)) for r in files] == [(d, s, n, i) for d, s, n, _, i in want]
    sums = starts(checksums(read_tokens(spark, path)), path).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sums] == [(d, s, n, c) for d, s, n, c, _ in want]
    assert len(list(Path(path.removeprefix("file:")).glob("*.orc"))) == part_starts(spark, path).count() > 1


def test_search_by_document_and_by_position(spark, corpus):
    rows, path = corpus
    want = {d: i for d, _, _, _, i in expected(rows)}
    assert {r.doc_id: list(r.ids) for r in find(spark, path, [6, 8, 4, 8997]).collect()} == {d: want[d] for d in (6, 8, 8997)}
    stream = [t for _, _, _, _, ids in expected(rows) for t in ids]
    for first, last in [(0, 1), (5, 900), (1000, 1003), (len(stream) - 4, len(stream) + 9), (len(stream), len(stream) + 5)]:
        found = sorted(tokens_between(spark, path, first, last).collect(), key=lambda r: r.start)
        assert [t for r in found for t in r.ids] == stream[first:last]
        assert not found or found[0].start == first


def test_metadata_prunes(spark, corpus, monkeypatch):
    _, path = corpus
    searched = find(spark, path, [6])
    plan = searched._jdf.queryExecution()
    assert "PushedFilters: [In(doc_id" in plan.toString() or "PushedFilters: [EqualTo(doc_id" in plan.toString() or "PushedFilters: [IsNotNull(doc_id), EqualTo" in plan.toString()
    monkeypatch.setattr(tokenfiles, "STRIPE_BYTES", 64 * 1024)
    rnd = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(f"{rnd.random():.12f}" for _ in range(40))) for i in range(8000)], "doc_id long, text string")
    many = write_tokens(docs.coalesce(1), PATH, 1)
    files = [orc.ORCFile(str(p)) for p in Path(many.removeprefix("file:")).glob("*.orc")]
    assert sum(f.nstripes for f in files) > len(files), "stripes below the size of a file"
    scan = find(spark, many, [1234])
    assert [r.doc_id for r in scan.collect()] == [1234]


def test_repeated_and_empty(spark):
    rows = [(1, "b c")] * 500 + [(1, "a")] * 3 + [(None, "z")] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = write_tokens(docs, PATH, 1)
    got = starts(checksums(read_tokens(spark, path)), path).orderBy("start").collect()
    assert len(got) == len(rows) and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert [r.doc_id for r in got] == [None] * 400 + [1] * 503
    empty = write_tokens(docs.limit(0), PATH, 1)
    assert starts(checksums(read_tokens(spark, empty)), empty).count() == 0
