"""Toxicity classifier with a counterfactual penalty.

A document is the set of its words and word beginnings (``PREFIXES`` bytes, so
inflected forms share evidence). Corpus jobs count them by label over the
training rows and keep the ``FEATURES`` most telling; a logistic regression is
fitted on them. For every training text with identity terms, copies are made in
which each term is swapped for another of its group, and the squared change of
the score's logit is added to the loss: evidence must not hang on who is named.

Training is bounded: at most ``TRAINING_ROWS`` labelled rows, the first by a
hash of their id, equal texts once, each reduced to the numbers of its kept
features. Scoring
reads every whole text and needs nothing but the text and the model.

Defined cases: a NULL or empty text gets the score of no evidence; a repeated
label counts once, as toxic if any copy says so; NULL labels and ids train
nothing; without rows of both labels every score is the share of toxic labels,
or 0 without any. Other columns are never read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .common import byte_texts, text_key

PREFIXES = (4, 5, 6)
FEATURES = 4096
#: The bound of the training sample.
TRAINING_ROWS = 20_000
FOLDS = 5
#: Rows whose words a task holds at a time.
ROWS = 128
#: Weights of the squared weights and of the squared counterfactual changes in the loss.
RIDGE, FAIRNESS = 2e-5, 1.0
SWAPS = 2

#: Terms that may stand for one another, by group; plain words, matched in lower case.
IDENTITY_TERMS = [
    ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"],
    ["women", "men", "girls", "boys", "transgender", "nonbinary"],
    ["woman", "man", "girl", "boy"],
    ["gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"],
    ["black", "white", "asian", "african", "european", "latino", "arab", "american"],
    ["immigrant", "refugee", "foreigner", "citizen", "native"],
    ["immigrants", "refugees", "foreigners", "citizens", "natives"],
    ["deaf", "blind", "disabled", "old", "young", "elderly"],
    ["musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"],
    ["femmes", "hommes", "filles", "garçons"],
    ["muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"],
    ["mujeres", "hombres", "niñas", "niños"],
]

#: A-Z is lowered and other ASCII than letters and digits separates words.
_LETTERS = (string.ascii_letters + string.digits).encode()
TABLE = bytes(ord(chr(c).lower()) if c in _LETTERS else c if c > 127 else 32 for c in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(TABLE).split())


def features_of(words: set[bytes]) -> set[bytes]:
    """Words, and their beginnings marked by a star."""
    return words | {w[:n] + b"*" for w in words for n in PREFIXES if len(w) > n}


def swaps(groups: list[list[str]]) -> dict[bytes, list[bytes]]:
    """For each identity term, the terms of its group after it, in turn."""
    out = {}
    for group in groups:
        terms = [t.encode() for t in group]
        for i, t in enumerate(terms):
            out[t] = [terms[(i + 1 + r * max(1, len(terms) // (SWAPS + 1))) % len(terms)] for r in range(SWAPS)]
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that must not train; a NULL id is not one of them, and trains nothing either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    """Weights by feature and the intercept."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -math.inf

    def score(self, text: bytes) -> float:
        z = self.bias
        words = words_of(text)
        found = words & self.weights.keys()
        for n in PREFIXES:
            found |= {w[:n] + b"*" for w in words if len(w) > n} & self.weights.keys()
        z += math.fsum(self.weights[f] for f in found)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def column(self, text: Column) -> Column:
        """The score of a text column, in Arrow batches."""
        model = self

        @F.arrow_udf("double")
        def toxicity(texts: pa.Array) -> pa.Array:
            return pa.array([model.score(t) for lo in range(0, len(texts), ROWS) for t in byte_texts(texts.slice(lo, ROWS))], pa.float64())

        return toxicity(text)


def training_labels(labels: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """(id, label) of at most ``bound`` rows that may train, the first by a hash of the id."""
    rows = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    once = rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).select(F.col("doc_id").alias("label_id"), "label")


def sample_rows(docs: DataFrame, labels: DataFrame, bound: int, groups: list[list[str]]) -> DataFrame:
    """(key, kind, label, features) of the distinct training texts: kind 0 the text itself, 1 and up its swapped copies."""
    chosen = stored(training_labels(labels, bound), "toxic-labels")
    # The sample's bound is the broadcast's bound: two numbers a row.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select(text_key().alias("key"), "label", "text")
    rows = rows.dropDuplicates(["key", "label"])
    other = swaps(groups)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, ROWS) for whole in batches for lo in range(0, whole.num_rows, ROWS)):
            out: list[tuple[int, int, int, list[bytes]]] = []
            for who, label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2))):
                words = words_of(text)
                out.append((who, 0, label, sorted(features_of(words))))
                named = words & other.keys()
                for r in range(SWAPS if named else 0):
                    changed = (words - named) | {other[t][r] for t in named}
                    out.append((who, r + 1, label, sorted(features_of(changed))))
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["key", "kind", "label", "features"])

    return stored(rows.mapInArrow(read, "key long, kind int, label int, features array<binary>"), "toxic-sample")


def telling_features(sample: DataFrame, n_toxic: int, n_clean: int, most: int = FEATURES) -> list[bytes]:
    """The features whose odds differ most between the labels, in standard errors; at most ``most``."""
    seen = sample.select("kind", "label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("label")).otherwise(0)).alias("a"), F.sum(F.when(F.col("kind") == 0, 1 - F.col("label")).otherwise(0)).alias("b"),
        F.max("kind").alias("swapped")).where("a + b >= 3 or swapped > 0")
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    c, d = F.lit(n_toxic + 1.0) - a, F.lit(n_clean + 1.0) - b
    z = F.abs(F.log(a / c) - F.log(b / d)) / F.sqrt(1 / a + 1 / c + 1 / b + 1 / d)
    rows = seen.withColumn("z", z).orderBy(F.desc("z"), "feature").limit(most).select("feature").collect()
    return [bytes(r.feature) for r in rows]


class Rows:
    """Sparse 0/1 rows: the feature numbers of each, one row after the other, and how many each has."""

    def __init__(self, sizes: np.ndarray, numbers: np.ndarray, width: int):
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.col, self.n, self.width = numbers, len(sizes), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.width)


def fit_weights(x: Rows, y: np.ndarray, pairs: np.ndarray, swapped: Rows, ridge: float, fairness: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression plus ``fairness`` times the mean squared logit change of ``swapped`` rows against rows ``pairs``.

    Accelerated gradient steps, scaled per feature by a bound of its curvature.
    """
    n = len(y)
    per_row = np.bincount(x.row, minlength=n).max(initial=0) + 1.0
    bound = x.back(np.full(n, 0.25 / n)) * per_row + ridge
    if swapped.n:
        wide = np.bincount(swapped.row, minlength=swapped.n).max(initial=0) + per_row
        spread = np.bincount(np.r_[x.col[np.isin(x.row, pairs)], swapped.col], minlength=x.width)
        bound += 2 * fairness / swapped.n * spread * wide * 0.5
    step_b = 0.25 * per_row
    w = v = np.zeros(x.width)
    b = c = math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    for t in range(rounds):
        z = x.times(v) + c
        r = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / n
        grad, grad_b = x.back(r) + ridge * v, r.sum()
        if swapped.n:
            change = swapped.times(v) + c - z[pairs]
            scaled = 2 * fairness / swapped.n * change
            grad += swapped.back(scaled) - x.back(np.bincount(pairs, scaled, n))
        new_w, new_b = v - grad / bound, c - grad_b / step_b
        pull = t / (t + 3)
        v, c = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS, fairness: float = FAIRNESS, ridge: float = RIDGE,
        groups: list[list[str]] | None = None, features: int = FEATURES) -> Model:
    """A model from the labelled rows outside the held-out fold."""
    sample = sample_rows(docs, labels, bound, IDENTITY_TERMS if groups is None else groups)
    own = sample.where("kind = 0").agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, rows = int(own[0]), int(own[1])
    if toxic in (0, rows):
        return Model({}, math.inf if rows and toxic else -math.inf)
    names = telling_features(sample, toxic, rows - toxic, features)
    known = pa.array(names, pa.binary())

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            found = pc.index_in(lists.flatten(), value_set=known)
            there = found.is_valid()
            before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
            ends = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.filter(there))], names=["key", "kind", "label", "found"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches, pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("label", pa.int32()), ("found", pa.list_(pa.int32()))]))
        got = got.sort_by([("kind", "ascending"), ("key", "ascending"), ("label", "ascending")]).combine_chunks()
        key, kind, label = (got.column(i).to_numpy() for i in range(3))
        base = int(np.searchsorted(kind, 0, "right"))

        def rows(lo: int, hi: int) -> Rows:
            lists = got.column(3).slice(lo, hi - lo).combine_chunks()
            return Rows(np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().astype(np.int64), len(names))

        # Texts come by key and label, so a copy's text is found by search.
        own = np.array(list(zip(key[:base], label[:base])), [("key", "i8"), ("label", "i4")])
        copies = np.array(list(zip(key[base:], label[base:])), own.dtype)
        w, b = fit_weights(rows(0, base), label[:base].astype(float), np.searchsorted(own, copies), rows(base, len(got)), ridge, fairness)
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64())), pa.array([b], pa.float64())], names=["weights", "bias"])

    # One task sees the bounded sample as feature numbers, and returns one row.
    reduced = sample.mapInArrow(numbered, "key long, kind int, label int, found array<int>")
    fitted = reduced.repartition(1).mapInArrow(train, "weights array<double>, bias double").first()
    return Model({f: w for f, w in zip(names, fitted.weights) if w}, fitted.bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score) of every row."""
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("text")).alias("score"))


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents scored under the limit; all columns stay as they are."""
    return docs.where(model.column(F.col("text")) < limit)
