"""Isolation forest (Liu, Ting & Zhou 2008): hash-sampled trees built and scored by tasks.

Each tree sees at most ``subsample`` rows, chosen by a hash of row id and tree
number, so a model can be rebuilt exactly whatever the partitioning. Trees are
built one per group; the model is a few hundred small arrays. Scoring is a
vectorised descent over all trees of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..constants import ANOMALY_FEATURES
from ..session import stored
from ..sources.tables import ensure_columns, spread
from .chunks import spread_by
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649


def average_path(n):
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    safe = np.where(big, n, 3.0)
    return np.where(big, 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe, out)


@dataclass
class Forest:
    """Complete binary trees as arrays (tree, node); ``feature`` -1 marks a leaf."""

    columns: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    depth: int
    norm: float
    offset: float | None = None
    #: Sampled rows that reached each node while it grew.
    cover: np.ndarray | None = None


def feature_frame(df: DataFrame, columns: Sequence[str] = ANOMALY_FEATURES) -> DataFrame:
    """Model inputs: absent columns and NULLs are 0."""
    df = ensure_columns(df, dict.fromkeys(columns, 0.0))
    return df.withColumns({f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


SPARE = 4


def tree_samples(df: DataFrame, columns: Sequence[str], row_id: Sequence[str], trees: int, subsample: int, seed: int) -> DataFrame:
    """(tree, rank, features): ``subsample`` rows per tree in hash order, all rows if there are fewer.

    About SPARE x trees x subsample (row, tree) candidates are made, however many
    rows there are: large inputs are thinned by a hash first, small ones give
    every row several trees, drawn by hashes. A tree's sample is the part of its
    candidates with the lowest hashes.
    """
    n = max(df.count(), 1)
    wanted = SPARE * trees * subsample
    top = 1 << 40
    if n > wanted:
        df = df.where(F.pmod(F.xxhash64(F.lit(seed), *row_id), F.lit(top)) < int(top * wanted / n))
    draws = -(-wanted // min(n, wanted))
    if n <= SPARE * subsample:
        chosen = F.sequence(F.lit(0), F.lit(trees - 1))
    else:
        drawn = [F.pmod(F.xxhash64(F.lit(seed + 1 + i), *row_id), F.lit(trees)).cast("int") for i in range(draws)]
        chosen = F.array_distinct(F.array(*drawn))
    candidates = df.select(*row_id, F.array(*[F.col(f"_f_{c}") for c in columns]).alias("x"), F.explode(chosen).alias("tree"))
    pick = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(-seed), F.col("tree"), *row_id), *row_id)
    return candidates.withColumn("_rn", F.row_number().over(pick)).where(F.col("_rn") <= subsample).select("tree", "_rn", "x")


def _build_tree(x: np.ndarray, depth: int, rng: np.random.Generator):
    """Grow all nodes of a level together; returns (feature, threshold, path, cover) by node."""
    size = (1 << (depth + 1)) - 1
    feature, threshold, cover = np.full(size, -1, np.int32), np.zeros(size), np.zeros(size)
    path = np.floor(np.log2(np.arange(size) + 1.0))
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for level in range(depth + 1):
        if not len(rows):
            break
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        ids, starts, counts = np.unique(node, return_index=True, return_counts=True)
        path[ids], cover[ids] = level + average_path(counts), counts
        if level == depth:
            break
        low, high = np.minimum.reduceat(x[rows], starts), np.maximum.reduceat(x[rows], starts)
        usable = high > low
        chance = np.where(usable, rng.random(usable.shape), -1.0)
        pick = chance.argmax(axis=1)
        at = np.arange(len(ids))
        cut = low[at, pick] + (high[at, pick] - low[at, pick]) * rng.random(len(ids))
        split = usable.any(axis=1)
        feature[ids[split]], threshold[ids[split]] = pick[split], cut[split]
        member = np.repeat(at, counts)
        keep = split[member]
        rows, node, member = rows[keep], node[keep], member[keep]
        node = 2 * node + 1 + (x[rows, pick[member]] > cut[member])
    return feature, threshold, path, cover


def fit_iforest(
    df: DataFrame, columns: Sequence[str] = ANOMALY_FEATURES, row_id: Sequence[str] = ("event_id",), *,
    trees: int = 100, subsample: int = 256, contamination: float = 0.05, seed: int = 42,
) -> Forest:
    """Build the forest, then set the offset at the contamination quantile of the training scores."""
    columns = list(columns)
    # Inputs are read three times (count, samples, scores): computed once, kept in the shared folder.
    frame = stored(feature_frame(df, columns).select(*row_id, *[f"_f_{c}" for c in columns]), "forest-inputs")
    samples = tree_samples(frame, columns, row_id, trees, subsample, seed)
    depth = int(np.ceil(np.log2(subsample)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rn")
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["x"].to_numpy())
        levels = max(1, int(np.ceil(np.log2(max(len(x), 2)))))
        f, t, p, c = _build_tree(x, min(levels, depth), np.random.default_rng([seed, tree]))
        pad = (1 << (depth + 1)) - 1 - len(f)
        return pd.DataFrame({
            "tree": [tree], "n": [len(x)], "feature": [np.pad(f, (0, pad), constant_values=-1)],
            "threshold": [np.pad(t, (0, pad))], "path": [np.pad(p, (0, pad))], "cover": [np.pad(c, (0, pad))]})

    # One row per tree: the collected model is trees x 2 * subsample numbers.
    rows = spread_by(samples, "tree").groupBy("tree").applyInPandas(
        build, "tree int, n int, feature array<int>, threshold array<double>, path array<double>, cover array<double>").collect()
    rows.sort(key=lambda r: r["tree"])
    forest = Forest(
        columns, np.array([r["feature"] for r in rows], np.int32), np.array([r["threshold"] for r in rows]),
        np.array([r["path"] for r in rows]), depth, float(average_path(max(r["n"] for r in rows))) or 1.0, cover=np.array([r["cover"] for r in rows]))
    scores = raw_scores(frame, forest).select(F.lit("all").alias("g"), "_score")
    forest.offset = exact_quantiles(scores, "g", "_score", [contamination]).first()["quantile"]
    return forest


def raw_scores(frame: DataFrame, forest: Forest) -> DataFrame:
    """Add ``_score`` = -2^(-mean depth / norm); lower is more anomalous."""

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        values = x.to_numpy(dtype=float)
        rows = np.arange(len(values))[:, None]
        tree = np.arange(len(forest.feature))[None, :]
        node = np.zeros((len(values), len(forest.feature)), np.int64)
        for _ in range(forest.depth):
            j = forest.feature[tree, node]
            right = values[rows, np.maximum(j, 0)] > forest.threshold[tree, node]
            node = np.where(j >= 0, 2 * node + 1 + right, node)
        return pd.Series(-np.exp2(-forest.path[tree, node].mean(axis=1) / forest.norm))

    # Not marked deterministic, so that a filter on the score does not compute it a second time.
    return spread(frame).withColumn("_score", score.asNondeterministic()(F.struct(*[F.col(f"_f_{c}").alias(c) for c in forest.columns])))


def score_iforest(df: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly_score`` (score above the offset is positive) and ``is_anomaly``."""
    scored = raw_scores(feature_frame(df, forest.columns), forest)
    gap = F.col("_score") - F.lit(forest.offset)
    out = scored.withColumn("anomaly_score", gap).withColumn("is_anomaly", gap < 0)
    return out.select(*df.columns, "anomaly_score", "is_anomaly")


@dataclass
class Boxes:
    """The leaves of all trees: ``low < x <= high`` per feature, the share of rows that splits on a feature leave, and the depth."""

    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_boxes(forest: Forest) -> Boxes:
    trees, nodes = forest.feature.shape
    d = len(forest.columns)
    low, high, share = np.full((trees, nodes, d), -np.inf), np.full((trees, nodes, d), np.inf), np.ones((trees, nodes, d))
    there = np.zeros((trees, nodes), bool)
    there[:, 0] = True
    for node in range(nodes // 2):
        at = np.flatnonzero(there[:, node] & (forest.feature[:, node] >= 0))
        f, cut = forest.feature[at, node], forest.threshold[at, node]
        for child in (2 * node + 1, 2 * node + 2):
            there[at, child] = True
            for a in (low, high, share):
                a[at, child] = a[at, node]
            share[at, child, f] *= forest.cover[at, child] / forest.cover[at, node]
        high[at, 2 * node + 1, f] = np.minimum(high[at, 2 * node + 1, f], cut)
        low[at, 2 * node + 2, f] = np.maximum(low[at, 2 * node + 2, f], cut)
    leaf = there & (forest.feature < 0)
    return Boxes(low[leaf], high[leaf], share[leaf], forest.path[leaf])


def shapley_depths(x: np.ndarray, boxes: Boxes, trees: int) -> np.ndarray:
    """Shapley values of each row's mean depth, features out of the coalition following the training rows' shares.

    A leaf's part is v times a product over the features of "inside" if known,
    "share" if not. Its Shapley value is the integral of a polynomial in the
    chance of being known, of a degree below the number of features, which a
    Gauss rule with half as many points gives exactly.
    """
    d = x.shape[1]
    points, weights = np.polynomial.legendre.leggauss(d // 2 + 1)
    out = np.zeros(x.shape)
    for i, row in enumerate(x):
        change = ((row > boxes.low) & (row <= boxes.high)) - boxes.share
        for t, w in zip((points + 1) / 2, weights / 2):
            factor = boxes.share + t * change
            whole = boxes.value * factor.prod(axis=1)
            out[i] += w * (change / factor * whole[:, None]).sum(axis=0)
    return out / trees


def explain_iforest(df: DataFrame, forest: Forest) -> DataFrame:
    """Add ``depth`` (mean depth, smaller is more anomalous), ``baseline`` and ``parts``: each feature's exact contribution.

    Baseline and contributions add up to the depth. Meant for the rows that were
    flagged: a row costs a pass over all leaves.
    """
    boxes, trees = leaf_boxes(forest), len(forest.feature)
    baseline = float((boxes.value * boxes.share.prod(axis=1)).sum() / trees)

    @F.pandas_udf("array<double>")
    def parts(x: pd.DataFrame) -> pd.Series:
        return pd.Series(list(shapley_depths(x.to_numpy(dtype=float), boxes, trees)))

    scored = raw_scores(feature_frame(df, forest.columns), forest)
    values = scored.withColumn("_parts", parts(F.struct(*[F.col(f"_f_{c}").alias(c) for c in forest.columns])))
    named = [F.struct(F.lit(c).alias("feature"), F.col("_parts")[i].alias("contribution")) for i, c in enumerate(forest.columns)]
    depth = -F.lit(forest.norm) * F.log2(-F.col("_score"))
    return values.select(*df.columns, depth.alias("depth"), F.lit(baseline).alias("baseline"), F.array(*named).alias("parts"))
