"""The source audit against plain counting, and the pointer sort against sorted words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hazeline.llm import divergence
from hazeline.llm.divergence import pointers, slice_terms, sorted_pointers, source_divergence

PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, lang string, source string, term string, I int"


def plain_terms(text):
    return [re.sub("[A-Z]+", lambda m: m.group().lower(), w) for w in re.findall(PATTERN, text or "")]


def plain_audit(rows, least):
    groups, df = {}, Counter()
    for text, lang, source in rows:
        words = plain_terms(text)
        groups.setdefault((lang or "", source or ""), Counter()).update(words)
        df.update((lang or "", w) for w in set(words))
    found = set()
    for lang in {g[0] for g in groups}:
        kept = {w for (g, w), k in df.items() if g == lang and k >= least}
        mine = {s: {w: c[w] for w in kept} for (g, s), c in groups.items() if g == lang}
        whole = {w: sum(c[w] for c in mine.values()) for w in kept}

        def p(c):
            return {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}

        ps, q = {s: p(c) for s, c in mine.items()}, p(whole)
        for s in mine:
            pairs = sorted(((-sum(abs(ps[s][w] - ps[o][w]) for w in kept), o.encode()) for o in mine if o != s))
            terms = sorted((q[w] - ps[s][w], w.encode()) for w in kept if mine[s][w] and ps[s][w] > q[w])[:50]
            for part, items in (("pair", pairs), ("term", terms)):
                found |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)}
    return found


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(80)] + ["Éa", "straße", "中文字", "averyverylongwordindeed" * 4, "averyverylongwordindeed" * 4 + "x", "AveryVeryLong", "averyverylon"]
    rows = []
    for _ in range(400):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "Ü", "s10", None])
        words = rnd.choices(vocabulary, weights=[1 + (hash((source, i)) % 5) for i in range(len(vocabulary))], k=rnd.randint(0, 60))
        rows.append((rnd.choice([" ", "-", "1", "\n"]).join(words), lang, source))
    rows += [(None, "en", "s1"), ("", "xx", "a"), ("!!", "xx", "b"), ("rare", "yy", "alone"), (("word1 word2," * 30_000) + "z" * 5000, "en", "s2")]
    return rows + [rows[3]] * 40


@pytest.mark.parametrize("tile, block, size", [(64, 4096, 1 << 23), (2, 7, 1 << 23), (3, 4096, 3000), (64, 1, 200)])
def test_against_plain_counts(spark, monkeypatch, tile, block, size):
    for name, value in (("TILE", tile), ("BLOCK", block), ("SLICE", size)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus()
    docs = spark.createDataFrame([(i, *r, "x", 1) for i, r in enumerate(rows)], DOCS).repartition(5)
    got = source_divergence(docs).collect()
    assert {tuple(r) for r in got} == plain_audit(rows, 30) and len(got) == len({tuple(r) for r in got})


def test_exact_beyond_64_bits(spark):
    """1e9 times a count leaves 64 bits; the probability is exact all the same."""
    n, total, v = 9 * 10**14 + 1, 10**15 + 7, 12345
    row = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(divergence.probability("n", "total", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(["a", "Ab", "abcdefgh", "abcdefghi", "abcdefgh" * 9, "abcdefgh" * 9 + "b", "é", " ", "-"]), max_size=12).map("".join)), max_size=8))
def test_pointer_sort(texts):
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data)])[:-1].astype(np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    low = divergence.LETTER[raw]
    at, size = pointers(low, starts)
    words = [w for t in texts for w in plain_terms(t)]
    assert [low[a:a + s].tobytes().decode() for a, s in zip(at, size)] == words
    order, fresh = sorted_pointers(low, at, size)
    ranked = [words[i] for i in order]
    assert [w.encode() for w in ranked] == sorted(w.encode() for w in words)
    assert all(i < j for (i, a), (j, b) in zip(zip(order, ranked), list(zip(order, ranked))[1:]) if a == b)
    assert fresh.tolist() == [i == 0 or ranked[i] != ranked[i - 1] for i in range(len(ranked))]
    term, _, n, df = slice_terms(raw, starts, np.zeros(len(texts), np.int64), 1)
    assert dict(zip(term.to_pylist(), n.tolist())) == Counter(words)
    assert dict(zip(term.to_pylist(), df.tolist())) == Counter(w for t in texts for w in set(plain_terms(t)))
