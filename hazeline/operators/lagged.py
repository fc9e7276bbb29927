"""Training on sliding windows without copying them: every row is read once, with the borders of its block.

A window is ``n_in`` input rows and the ``n_out`` targets behind them. The
cross-products of all windows of a block depend on pairs of rows a fixed
distance apart only, so the matrix is made of lagged products: for each lag one
product of the block with itself, and for each further pair of places the rows
that enter and leave at the two ends (block-Toeplitz with border corrections).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .chunks import BLOCK_ROWS, as_list, numbered, with_row_halo
from .regression import add_to, huber_products, in_pieces, piece_schema, summed

#: Windows that are laid out as rows at a time where a loss needs each by itself.
SLICE = 2048


def window_blocks(df: DataFrame, key: str | Sequence[str], ts: str, inputs: Sequence[str], target: str, n_in: int, n_out: int,
                  ties: Sequence[str] = (), block_rows: int = BLOCK_ROWS, chunk_us: int | None = None) -> DataFrame:
    """(keys, _block, _seq, _own, _u): rows by block with their inputs and, last, their target."""
    keys = as_list(key)
    rows = numbered(df.select(*dict.fromkeys([*keys, ts, *ties, *inputs, target])), keys, ts, ties, size_us=chunk_us)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in (*inputs, target)])
    return with_row_halo(rows.select(*keys, "_seq", values.alias("_u")), "_seq", n_in - 1, n_out, block_rows)


def runs_of_windows(pdf: pd.DataFrame, n_in: int, n_out: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(u, lo, hi): rows of a block and the first and last place of windows, as long as no value is missing."""
    pdf = pdf.sort_values("_seq")
    u = np.stack(pdf["_u"].to_numpy())
    own, n = pdf["_own"].to_numpy(bool), len(u)
    bad_in = np.concatenate([[0], np.cumsum(np.isnan(u[:, :-1]).any(axis=1))])
    bad_out = np.concatenate([[0], np.cumsum(np.isnan(u[:, -1]))])
    at = np.flatnonzero(own)
    at = at[(at >= n_in - 1) & (at + n_out < n)]
    at = at[(bad_in[at + 1] == bad_in[at + 1 - n_in]) & (bad_out[at + 1 + n_out] == bad_out[at + 1])]
    u = np.nan_to_num(u)
    for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
        if len(run):
            yield u, int(run[0]), int(run[-1])


def lagged_products(u: np.ndarray, lo: int, hi: int, n_in: int, n_out: int) -> np.ndarray:
    """Cross-products of [1, inputs of the window, oldest first, targets], summed over the windows that end in lo..hi."""
    m, span = u.shape[1], n_in + n_out
    first = lo - n_in + 1
    pair = np.empty((span, span, m, m))
    for lag in range(span):
        places = span - lag
        a, b = u[first:], u[first + lag:]
        count = hi - lo + 1
        base = a[:count].T @ b[:count]
        # From one pair of places to the next, one row leaves at the front and one enters behind.
        leave = np.einsum("ia,ib->iab", a[:places - 1], b[:places - 1])
        enter = np.einsum("ia,ib->iab", a[count:count + places - 1], b[count:count + places - 1])
        sums = np.concatenate([base[None], base[None] + np.cumsum(enter - leave, axis=0)])
        i = np.arange(places)
        pair[i, i + lag], pair[i + lag, i] = sums, sums.transpose(0, 2, 1)
    place = np.concatenate([np.repeat(np.arange(n_in), m - 1), np.arange(n_in, span)])
    value = np.concatenate([np.tile(np.arange(m - 1), n_in), np.full(n_out, m - 1)])
    gram = np.empty((len(place) + 1, len(place) + 1))
    gram[1:, 1:] = pair[place[:, None], place[None, :], value[:, None], value[None, :]]
    total = np.concatenate([np.zeros((1, m)), np.cumsum(u, axis=0)])
    begin = first + place
    gram[0, 0] = hi - lo + 1
    gram[0, 1:] = gram[1:, 0] = total[begin + hi - lo + 1, value] - total[begin, value]
    return gram


def laid_out(u: np.ndarray, lo: int, hi: int, n_in: int, n_out: int) -> Iterator[np.ndarray]:
    """The windows as rows [1, inputs, targets], ``SLICE`` at a time."""
    for a in range(lo, hi + 1, SLICE):
        ends = np.arange(a, min(a + SLICE, hi + 1))[:, None]
        x = u[ends + np.arange(1 - n_in, 1), :-1].reshape(len(ends), -1)
        yield np.column_stack([np.ones(len(ends)), x, u[ends + np.arange(1, n_out + 1), -1]])


def window_products(blocks: DataFrame, key: str | Sequence[str], n_in: int, n_out: int) -> DataFrame:
    """(n, gram) of all windows, as ``cross_products`` gives them for materialised ones."""

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        held: dict = {}
        for u, lo, hi in runs_of_windows(pdf, n_in, n_out):
            add_to(held, {(): (hi - lo + 1, lagged_products(u, lo, hi, n_in, n_out))})
        return in_pieces(held, [])

    return summed(blocks.groupBy(*as_list(key), "_block").applyInPandas(reduce, piece_schema(blocks, [])), [])


def weighted_window_products(blocks: DataFrame, key: str | Sequence[str], n_in: int, n_out: int, p: int, coef: np.ndarray, intercept: np.ndarray, delta: float) -> DataFrame:
    """(_target, n, gram) of all windows under the Huber weights of a model."""

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        held: dict = {}
        for u, lo, hi in runs_of_windows(pdf, n_in, n_out):
            for v in laid_out(u, lo, hi, n_in, n_out):
                add_to(held, huber_products(v, p, coef, intercept, delta))
        return in_pieces(held, ["_target"])

    return summed(blocks.groupBy(*as_list(key), "_block").applyInPandas(reduce, piece_schema(blocks, [], "_target int, ")), ["_target"])
