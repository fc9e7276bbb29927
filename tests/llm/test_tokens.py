"""Token counts against the library of the vocabulary."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hazeline.llm.tokens import Merges, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN, LIBRARY = Merges(PATH), Tokenizer.from_file(PATH)


def counted(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|", "don't", " I'LL", "ΟΔΟΣ", "İ", "é", "12½", "%%%", " ", "\x1c", "🇩🇪", "中文", "thing"]), max_size=12).map("".join)))
def test_against_the_library(text):
    assert OWN.count(text) == counted(text)


def test_long_pieces():
    rnd = random.Random(4)
    for n in (500, 20_000):
        text = "".join(rnd.choice("etaoinshrdlu") for _ in range(n))
        assert OWN.count(text) == counted(text)


def test_frames(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "<|endoftext|>x"), (5, "word " * 30_000)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.id, r.n_bytes, r.n_tokens) for r in token_counts(docs, PATH).collect()), key=str)
    assert got == sorted(((d, len((t or "").encode()), counted(t or "")) for d, t in rows), key=str)
    assert token_counts(docs.limit(0), PATH).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    spec = tmp_path / "v.json"
    spec.write_text('{"model": {"type": "Unigram"}, "normalizer": {"type": "NFC"}, "pre_tokenizer": {"pretokenizers": []}, "added_tokens": []}')
    with pytest.raises(ValueError):
        Merges(str(spec))


@pytest.mark.parametrize("text", ["🇩🇪\U0001915d", "İ\u058cdon't", "thing\ua7cb", "\ua7dc1", "\U00016ea0a\U00010d50", "a\U0001e6c01\u208f%%%"])
def test_characters_younger_than_the_library(text):
    assert OWN.count(text) == counted(text)
