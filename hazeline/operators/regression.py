"""Ridge regression from summed cross-products, shared or per key, one or many targets.

Without keys, tasks reduce their rows to one cross-product matrix, and the
matrices are added piece by piece in two steps. Per key, Spark sums the products
before and after its shuffle, so neither a key owning most rows meets in one
task nor do many keys cost Python a call each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .chunks import as_list

#: Bytes of matrices a task solves at once, numbers of a piece that travels, and groups of tasks that are added first.
HELD_BYTES = 64 << 20
PIECE = 1 << 15
SLOTS = 32
#: Matrices per key of at most this width are summed as one row, wider ones as a row per line.
NARROW = 16


@dataclass
class LinearModel:
    """Coefficients on raw inputs: prediction = intercept + x · coef, per target."""

    names: list[str]
    coef: np.ndarray
    intercept: np.ndarray
    mean: np.ndarray
    sigma: np.ndarray
    n: int


def complete_rows(df: DataFrame, x: Column, y: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, _v): [1, x, y] of the rows without NULL and NaN."""
    rows = df.select(*by, F.concat(F.array(F.lit(1.0)), x, y).alias("_v"))
    return rows.where(~F.exists("_v", lambda v: v.isNull() | F.isnan(v)))


def cross_products(df: DataFrame, x: Column, y: Column, width: int, by: Sequence[str] = (), slots: int = SLOTS) -> DataFrame:
    """(by, n, gram): flattened cross-products of [1, x, y] summed per key."""
    keys, rows = list(by), complete_rows(df, x, y, by)
    if keys:
        return keyed_products(rows, width, keys)

    def reduce_batches(batches):
        n, g = 0, 0.0
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["_v"].to_numpy())
                n, g = n + len(v), g + v.T @ v
        if n:
            yield in_pieces({(): (n, g)}, [])

    return summed(rows.mapInPandas(reduce_batches, piece_schema(rows, [])), [], slots)


def keyed_products(rows: DataFrame, width: int, keys: Sequence[str]) -> DataFrame:
    """(keys, n, gram) of ``complete_rows``: plain sums, of all products where they are few, else line by line."""
    v, count = F.col("_v"), F.count(F.lit(1)).alias("n")
    if width <= NARROW:
        sums = [F.sum(v[i] * v[j]).alias(f"_g{i}_{j}") for i in range(width) for j in range(i, width)]
        gram = F.array(*[F.col(f"_g{min(i, j)}_{max(i, j)}") for i in range(width) for j in range(width)])
        return rows.groupBy(*keys).agg(count, *sums).select(*keys, "n", gram.alias("gram"))
    lines = rows.select(*keys, "_v", F.posexplode("_v").alias("_i", "_x"))
    line = F.array(*[F.col(f"_g{j}") for j in range(width)])
    added = lines.groupBy(*keys, "_i").agg(count, *[F.sum(F.col("_x") * v[j]).alias(f"_g{j}") for j in range(width)])
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_i", line.alias("line")))), lambda p: p["line"]))
    return added.groupBy(*keys).agg(F.max("n").alias("n"), whole.alias("gram"))


def piece_schema(rows: DataFrame, keys: Sequence[str], extra: str = "") -> str:
    types = "".join(f"{c} {t}, " for c, t in rows.dtypes if c in keys)
    return f"{types}{extra}_piece int, _slot int, n long, gram array<double>"


def in_pieces(held: dict, keys: Sequence[str]) -> pd.DataFrame:
    """Matrices by key, cut into rows of at most ``PIECE`` numbers."""
    out = []
    for k, (n, g) in held.items():
        lines = max(1, PIECE // len(g))
        out += [{**dict(zip(keys, k)), "_piece": a // lines, "_slot": 0, "n": n, "gram": g[a:a + lines].ravel()} for a in range(0, len(g), lines)]
    return pd.DataFrame(out, columns=[*keys, "_piece", "_slot", "n", "gram"])


def summed(partial: DataFrame, keys: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(keys, n, gram): matrices that tasks gave in pieces, added.

    Pieces are added per (key, piece, slot) and then per (key, piece): no group
    holds whole matrices of many tasks, however wide they are.
    """
    schema = ", ".join(f"{c} {t}" for c, t in partial.dtypes)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[[0]][[*keys, "_piece", "_slot"]].reset_index(drop=True)
        total = np.zeros(len(pdf["gram"].iloc[0]))
        for g in pdf["gram"]:
            total += g
        return first.assign(n=int(pdf["n"].sum()), gram=[total])

    partial = partial.withColumn("_slot", (F.spark_partition_id() % slots).cast("int"))
    once = partial.groupBy(*keys, "_piece", "_slot").applyInPandas(add, schema)
    twice = once.withColumn("_slot", F.lit(0)).groupBy(*keys, "_piece").applyInPandas(add, schema)
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "gram"))), lambda p: p["gram"]))
    return twice.groupBy(*keys).agg(F.max("n").alias("n"), whole.alias("gram")).where("n is not null").select(*keys, "n", "gram")


def huber_products(v: np.ndarray, p: int, coef: np.ndarray, intercept: np.ndarray, delta: float) -> dict:
    """Per target, (rows, cross-products of [1, x, y] under the weights of the Huber loss) for rows [1, x, y...]."""
    x1, y = v[:, :p + 1], v[:, p + 1:]
    miss = np.abs(y - x1[:, 1:] @ coef - intercept)
    weight = delta / np.maximum(miss, delta)
    out = {}
    for j in range(y.shape[1]):
        u = np.column_stack([x1, y[:, j]])
        out[(j,)] = (len(u), u.T @ (u * weight[:, j:j + 1]))
    return out


def weighted_products(df: DataFrame, x: Column, y: Column, p: int, coef: np.ndarray, intercept: np.ndarray, delta: float) -> DataFrame:
    """(_target, n, gram): one aggregate over the rows, weighted by how far the given model misses them."""
    rows = complete_rows(df, x, y)

    def reduce_batches(batches):
        held: dict = {}
        for pdf in batches:
            if len(pdf):
                add_to(held, huber_products(np.stack(pdf["_v"].to_numpy()), p, coef, intercept, delta))
        if held:
            yield in_pieces(held, ["_target"])

    return summed(rows.mapInPandas(reduce_batches, piece_schema(rows, [], "_target int, ")), ["_target"])


def add_to(held: dict, more: dict) -> None:
    for k, (n, g) in more.items():
        m, h = held.get(k, (0, 0.0))
        held[k] = (m + n, h + g)


def reweighted(start: LinearModel, products: Callable[[np.ndarray, np.ndarray], DataFrame], ridge: float, rounds: int, tolerance: float) -> LinearModel:
    """Least squares repeated under the weights of the model before, until no prediction at the mean inputs or coefficient moves.

    ``products`` gives (_target, n, gram) for a model; each round is one such
    aggregate, and one matrix per target reaches the driver.
    """
    p, model = len(start.names), start
    for _ in range(rounds):
        rows = sorted(products(model.coef, model.intercept).collect(), key=lambda r: r["_target"])
        found = [solve(np.array(r["gram"]).reshape(p + 2, p + 2), p, 1, ridge) for r in rows]
        coef, intercept = np.column_stack([f[0][:, 0] for f in found]), np.array([f[1][0] for f in found])
        sigma = np.array([f[3][0] for f in found])
        scale = np.maximum(np.abs(coef).max(), 1e-12)
        moved = max(np.abs(coef - model.coef).max() / scale, np.abs(intercept - model.intercept).max() / max(1.0, np.abs(intercept).max()))
        model = LinearModel(start.names, coef, intercept, start.mean, sigma, start.n)
        if moved <= tolerance:
            break
    return model


def fit_huber(df: DataFrame, x: Column, y: Column, names: Sequence[str], targets: int = 1, ridge: float = 1e-3, delta: float = 1.0,
              rounds: int = 50, tolerance: float = 1e-6) -> LinearModel:
    """A shared model under the Huber loss: squared up to ``delta``, linear beyond, so that outliers pull with bounded force."""
    start = fit_linear(df, x, y, names, targets, ridge)
    return reweighted(start, lambda coef, intercept: weighted_products(df, x, y, len(names), coef, intercept, delta), ridge, rounds, tolerance)


def sparse_descent(a: np.ndarray, b: np.ndarray, l1: np.ndarray, sweeps: int = 20_000, tolerance: float = 1e-10) -> np.ndarray:
    """Minimiser of w'aw / 2 - b'w + sum of l1 |w|, coordinate by coordinate, per column of ``b``."""
    w, diag = np.zeros(b.shape), np.diag(a)
    left = b - a @ w
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(a)):
            pull = left[j] + diag[j] * w[j]
            step = np.sign(pull) * np.maximum(np.abs(pull) - l1[j], 0.0) / diag[j] - w[j]
            if step.any():
                w[j] += step
                left -= np.outer(a[:, j], step)
                most = max(most, np.abs(step).max())
        if most <= tolerance * max(1.0, np.abs(w).max()):
            break
    return w


def solve(gram: np.ndarray, p: int, q: int, ridge: float, l1: np.ndarray | None = None):
    """Centred, scaled ridge solution from the cross-products of [1, x (p), y (q)]; ``l1`` penalises sizes of scaled coefficients.

    Matrices may be stacked along leading axes; each is solved by itself.
    """
    n = gram[..., 0, 0]
    mean = gram[..., 0, 1:] / n[..., None]
    cov = gram[..., 1:, 1:] / n[..., None, None] - mean[..., :, None] * mean[..., None, :]
    xx, xy, yy = cov[..., :p, :p], cov[..., :p, p:], cov[..., p:, p:]
    scale = np.sqrt(np.maximum(np.einsum("...ii->...i", xx), 0.0))
    live = scale > 1e-9 * np.maximum(1.0, np.abs(mean[..., :p]))
    scale = np.where(live, scale, 1.0)
    a = np.where(live[..., :, None] & live[..., None, :], xx / (scale[..., :, None] * scale[..., None, :]), 0.0)
    b = np.where(live[..., None], xy / scale[..., None], 0.0)
    a = a + (ridge + 1e-12) * np.eye(p) + (~live)[..., None] * np.eye(p)
    if l1 is None:
        beta = np.linalg.solve(a, b)
    else:
        beta = np.empty_like(b)
        for at in np.ndindex(b.shape[:-2]):
            beta[at] = sparse_descent(a[at], b[at], l1)
    beta = beta / scale[..., None]
    intercept = mean[..., p:] - np.einsum("...i,...ij->...j", mean[..., :p], beta)
    residual = np.einsum("...jj->...j", yy) - 2 * np.einsum("...ij,...ij->...j", beta, xy) + np.einsum("...ij,...ij->...j", beta, xx @ beta)
    return beta, intercept, mean[..., :p], np.sqrt(np.maximum(residual, 0.0)), n


def fit_linear(df: DataFrame, x: Column, y: Column, names: Sequence[str], targets: int = 1, ridge: float = 1e-3, l1: np.ndarray | None = None) -> LinearModel:
    """One shared model; what reaches the driver is one cross-product matrix."""
    return model_of(cross_products(df, x, y, 1 + len(names) + targets), names, targets, ridge, l1)


def model_of(products: DataFrame, names: Sequence[str], targets: int, ridge: float, l1: np.ndarray | None = None) -> LinearModel:
    """The model of one row of summed cross-products."""
    p, row = len(names), products.first()
    if row is None:
        raise ValueError("no complete training rows")
    coef, intercept, mean, sigma, n = solve(np.array(row["gram"]).reshape(1 + p + targets, 1 + p + targets), p, targets, ridge, l1)
    return LinearModel(list(names), coef, intercept, mean, sigma, int(n))


def fit_linear_by(df: DataFrame, x: Column, y: Column, names: Sequence[str], by: str | Sequence[str], ridge: float = 1e-3, l1: np.ndarray | None = None) -> DataFrame:
    """One model row per key: (by, n, intercept, coef, mean, sigma)."""
    keys, p = as_list(by), len(names)
    width = p + 2

    def fit(batches):
        for pdf in batches:
            step = max(1, HELD_BYTES // (8 * width * width))
            for lo in range(0, len(pdf), step):
                some = pdf.iloc[lo:lo + step]
                coef, intercept, mean, sigma, _ = solve(np.stack(some["gram"].to_numpy()).reshape(-1, width, width), p, 1, ridge, l1)
                yield some[[*keys, "n"]].assign(intercept=intercept[:, 0], coef=list(coef[:, :, 0]), mean=list(mean), sigma=sigma[:, 0])

    grams = cross_products(df, x, y, width, keys)
    types = "".join(f"{c} {t}, " for c, t in grams.dtypes if c in keys)
    return grams.mapInPandas(fit, f"{types}n long, intercept double, coef array<double>, mean array<double>, sigma double")


def dot(x: Column, coef: Column) -> Column:
    return F.aggregate(F.zip_with(x, coef, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def predict(model: LinearModel, x: Column, target: int = 0) -> Column:
    """JVM-side prediction with the coefficients as literals."""
    coef = F.array(*[F.lit(float(c)) for c in model.coef[:, target]])
    return F.lit(float(model.intercept[target])) + dot(x, coef)


def contribution_array(terms: dict[str, tuple[float, float]]) -> Column:
    """Exact linear contributions ``coef · (x - mean)`` as array<struct<feature, contribution>>."""
    return F.array(*[
        F.struct(F.lit(c).alias("feature"), ((F.col(c) - F.lit(m)) * F.lit(b)).alias("contribution")) for c, (b, m) in terms.items()])


def contributions(df: DataFrame, keys: Sequence[str], terms: dict[str, tuple[float, float]]) -> DataFrame:
    """Long form (keys, feature, contribution)."""
    return df.select(*keys, F.inline(contribution_array(terms)))


def importance(parts: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return parts.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance")).orderBy(F.desc("importance"), "feature")
