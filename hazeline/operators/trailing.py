"""Trailing time-range statistics in linear time.

Spark's sliding range frame adds up the whole frame again for every row. Here
rows are sorted once per (key, time chunk), running sums are formed over them,
and each window is the difference of two running sums whose places a binary
search finds: the cost per row does not depend on the rows per window.

Values are centred on their group and summed in extended precision, so large
offsets and long chunks leave the deviations exact. Arrow batches of sorted rows
stream through; only the group that a batch ends in is carried to the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .chunks import HOUR_US


def window_sums(group: np.ndarray, us: np.ndarray, value: np.ndarray, windows: Sequence[int]) -> dict[int, tuple[np.ndarray, ...]]:
    """(n, sum, mean, variance sum) of non-null values in ``(t - window, t]`` for rows sorted by group and time.

    ``value`` holds NaN for NULL. Rows of equal time see one another.
    """
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    number = np.cumsum(np.r_[False, group[1:] != group[:-1]])
    there = ~np.isnan(value)
    filled = np.where(there, value, 0.0)
    counts = np.add.reduceat(there, heads, dtype=np.int64)
    centre = (np.add.reduceat(filled, heads) / np.maximum(counts, 1))[number]
    off = np.where(there, value - centre, 0.0).astype(np.longdouble)
    running = [np.r_[c.dtype.type(0), np.cumsum(c)] for c in (there.astype(np.int64), off, off * off)]
    # Changes from one non-null value to the next: a window without any has no deviation at all.
    dense = value[there]
    changes = np.cumsum(np.r_[0, dense[1:] != dense[:-1]]) if len(dense) else np.zeros(1, np.int64)
    # One rising axis for all groups: a step between groups wider than any window.
    start = us[heads]
    span = int((us - start[number]).max()) + max(windows) + 1
    axis = number * span + (us - start[number])
    last = np.searchsorted(axis, axis, side="right")
    out = {}
    for w in windows:
        first = np.maximum(np.searchsorted(axis, axis - w, side="right"), heads[number])
        n, s, q = (r[last] - r[first] for r in running)
        some = np.maximum(n, 1)
        mean = s / some + centre
        final = np.maximum(running[0][last] - 1, 0)
        even = (n > 0) & (changes[final] == changes[np.minimum(running[0][first], len(changes) - 1)])
        q = np.where(even, s * s / some, q)
        out[w] = n, (s + n * centre.astype(np.longdouble)).astype(float), mean.astype(float), np.maximum(q - s * s / some, 0).astype(float)
    return out


def trailing_columns(df: DataFrame, group: Sequence[str], us: str, value: str, spec: dict[str, tuple[str, float]], *,
                     own: str | None = None, ties: Sequence[str] = (), place: str | None = None) -> DataFrame:
    """Add the statistics of ``spec``: name -> (mean, std or sum, hours), one shuffle and one sort for all.

    ``own`` names a flag of the rows that stay; ``place`` adds their running
    number within the group, in the order of time and ``ties``.
    """
    columns = df.columns
    windows = {name: int(hours * HOUR_US) for name, (_, hours) in spec.items()}
    added = [*spec, *([place] if place else [])]
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in spec], *([T.StructField(place, T.LongType())] if place else [])])

    def finish(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        number = rows.column("_group").to_numpy()
        cast = rows.column("_value").to_numpy(zero_copy_only=False).astype(float)
        sums = window_sums(number, rows.column(us).to_numpy(), cast, sorted(set(windows.values())))
        kept = rows.select(columns)
        for name, (kind, _) in spec.items():
            n, total, mean, spread = sums[windows[name]]
            if kind == "std":
                got, few = np.sqrt(spread / np.maximum(n - 1, 1)), n < 2
            else:
                got, few = (mean if kind == "mean" else total), n < 1
            kept = kept.append_column(name, pa.array(got, pa.float64(), mask=few))
        if place:
            mine = rows.column(own).to_numpy(zero_copy_only=False).astype(np.int64) if own else np.ones(len(number), np.int64)
            heads = np.r_[True, number[1:] != number[:-1]]
            running = np.cumsum(mine)
            before = np.maximum.accumulate(np.where(heads, running - mine, 0))
            kept = kept.append_column(place, pa.array(running - before, pa.int64()))
        if own:
            kept = kept.filter(kept.column(own))
        yield from kept.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(batch.schema.get_field_index("_group")).to_numpy()
            cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
            goes_on = bool(held) and held[-1].column(batch.schema.get_field_index("_group"))[-1].as_py() == int(ids[0])
            if held and (not goes_on or len(cuts)):
                # Everything before the group this batch ends in is complete.
                cut = int(cuts[-1]) if len(cuts) else 0
                yield from finish(pa.Table.from_batches([*held, batch.slice(0, cut)] if cut else held))
                held = [batch.slice(cut)]
            elif not held and len(cuts):
                yield from finish(pa.Table.from_batches([batch.slice(0, int(cuts[-1]))]))
                held = [batch.slice(int(cuts[-1]))]
            else:
                held.append(batch)
        if held:
            yield from finish(pa.Table.from_batches(held))

    marked = df.withColumns({"_group": F.xxhash64(*group), "_value": F.col(value).cast("double")})
    ordered = marked.repartition(*group).sortWithinPartitions("_group", us, *ties)
    return ordered.mapInArrow(run, schema).select(*columns, *added)
