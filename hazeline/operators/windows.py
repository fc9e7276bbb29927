"""Per-station series operators: trailing statistics, lags, fill, sequences, runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import LAG_ROWS
from .chunks import (
    BLOCK_ROWS, HOUR_US, as_list, measured_chunk, numbered, over_rows, time_chunk, with_time_halo,
)
from .trailing import trailing_columns
from ..functions.timefns import micros


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """First row per key in an explicit order.

    The ``row_number = 1`` filter is applied before the shuffle as well, so a key
    with many copies sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def coalesce_readings(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key holding the first non-null of every value column."""
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values])


def trailing(
    df: DataFrame, key: str | Sequence[str], ts: str, value: str, spec: dict[str, tuple[str, float]],
    *, chunk_us: int | None = None,
) -> DataFrame:
    """Trailing time-range statistics over ``(t - hours, t]``.

    ``spec`` maps an output name to ``(aggregate, hours)`` with aggregates
    ``mean``, ``std`` (sample), ``sum``. All windows share one shuffle and one sort,
    and the cost per row does not grow with the rows per window. Unless a chunk
    length is given, it is measured on the data.
    """
    keys = as_list(key)
    reach = int(max(h for _, h in spec.values()) * HOUR_US)
    spread = with_time_halo(df, ts, reach, chunk_us or measured_chunk(df, keys, ts, reach))
    return trailing_columns(spread, [*keys, "_chunk"], "_us", value, spec, own="_own").drop("_us", "_chunk", "_own")


def row_lags(
    df: DataFrame, key: str | Sequence[str], ts: str, value: str, lags: Sequence[int] = LAG_ROWS,
    *, names: Sequence[str] | None = None, ties: Sequence[str] = (), block_rows: int = BLOCK_ROWS,
    chunk_us: int | None = None,
) -> DataFrame:
    """Values a fixed number of rows earlier in the same series."""
    names = names or [f"{value}_lag_{n}h" for n in lags]
    return over_rows(
        df, key, ts, lambda w: {name: F.lag(value, n).over(w) for name, n in zip(names, lags)},
        before=max(lags), ties=ties, size=block_rows, size_us=chunk_us,
    )


def time_lags(df: DataFrame, key: str | Sequence[str], ts: str, value: str, hours: Sequence[int]) -> DataFrame:
    """Values exactly n hours earlier (NULL where the series has a gap), from one shuffle.

    Each row also travels as a copy per offset, moved to the time that looks back
    at it; rows and copies of one key and time meet in one group. Past rows of
    equal key and time must not differ: their largest value is taken.
    """
    keys = as_list(key)
    names = [f"{value}_at_{h}h" for h in hours]
    here = df.select(*keys, ts, F.struct(*df.columns).alias("_row"), *[F.lit(None).cast(df.schema[value].dataType).alias(n) for n in names])
    moves = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.col(ts) + F.expr(f"interval {h} hours")).alias("at")) for i, h in enumerate(hours)]))
    moved = df.select(*keys, F.col(value).alias("_v"), moves.alias("_m"))
    past = moved.select(*keys, F.col("_m.at").alias(ts), F.lit(None).cast(here.schema["_row"].dataType).alias("_row"),
                        *[F.when(F.col("_m.i") == i, F.col("_v")).alias(n) for i, n in enumerate(names)])
    both = here.unionByName(past)
    window = Window.partitionBy(*keys, ts)
    seen = both.select("_row", *[F.max(n).over(window).alias(n) for n in names]).where("_row is not null")
    return seen.select("_row.*", *names)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; combines map-side, so a hot key sends one row per task."""
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*")


def last_rows(df: DataFrame, key: str | Sequence[str], ts: str, n: int, ties: Sequence[str] = (), rank: str = "_back") -> DataFrame:
    """The last n rows per key, ``rank`` 1 = newest; the limit is applied before the shuffle."""
    window = Window.partitionBy(*as_list(key)).orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in ties])
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def forward_fill(
    df: DataFrame, key: str | Sequence[str], ts: str, values: Sequence[str], default: float | None = 0.0,
    *, ties: Sequence[str] = (), chunk_us: int | None = None,
) -> DataFrame:
    """Last non-null value so far, then a default.

    Inside a (key, chunk) this is a running ``last``. The last value of every
    chunk, one row per chunk, is carried over the chunks and fills rows that
    precede the first value of their own chunk.
    """
    keys = as_list(key)
    base = df.withColumn("_chunk", time_chunk(micros(F.col(ts)), chunk_us or measured_chunk(df, keys, ts)))
    rank = F.struct(ts, *ties)
    ends = base.groupBy(*keys, "_chunk").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), rank)).alias(f"_end_{v}") for v in values])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "_chunk", *[
        F.last(f"_end_{v}", ignorenulls=True).over(before).alias(f"_carry_{v}") for v in values])
    run = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumns({f"_local_{v}": F.last(v, ignorenulls=True).over(run) for v in values})
    joined = local.join(carry.hint("shuffle_hash"), [*keys, "_chunk"])
    filled = {}
    for v in values:
        parts = [F.col(f"_local_{v}"), F.col(f"_carry_{v}")]
        if default is not None:
            parts.append(F.lit(default))
        filled[v] = F.coalesce(*parts)
    return joined.withColumns(filled).select(*df.columns)


def sequences(
    df: DataFrame, key: str | Sequence[str], ts: str, inputs: Sequence[str], target: str,
    n_in: int = 48, n_out: int = 24, *, ties: Sequence[str] = (), block_rows: int = BLOCK_ROWS,
    chunk_us: int | None = None,
) -> DataFrame:
    """Complete sliding windows: ``n_in`` input rows followed by ``n_out`` targets, stride 1.

    ``y_ts`` has the times of the targets: they are the next rows, whatever the gaps.
    Inputs are filled beforehand (``forward_fill``): collected arrays skip NULLs.
    """
    keys = as_list(key)

    def build(window):
        return {
            "x": F.collect_list(F.array(*[F.col(c).cast("double") for c in inputs])).over(window.rowsBetween(-(n_in - 1), 0)),
            "y": F.collect_list(target).over(window.rowsBetween(1, n_out)),
            "y_ts": F.collect_list(ts).over(window.rowsBetween(1, n_out)),
        }

    rows = over_rows(
        df.select(*dict.fromkeys([*keys, ts, *ties, *inputs, target])), keys, ts, build,
        before=n_in - 1, after=n_out, ties=ties, size=block_rows, size_us=chunk_us)
    return rows.where((F.size("x") == n_in) & (F.size("y") == n_out)).select(*keys, ts, "x", "y", "y_ts")


def last_context(df: DataFrame, key: str | Sequence[str], ts: str, value: str, n: int = 48, ties: Sequence[str] = ()) -> DataFrame:
    """The last n values per key, oldest first, padded with zeros on the left."""
    keys = as_list(key)
    recent = last_rows(df, keys, ts, n, ties)
    packed = recent.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(-F.col("_back"), value))).alias("_p"))
    values = F.transform("_p", lambda p: F.coalesce(p[value], F.lit(0.0)))
    return packed.select(*keys, F.concat(F.array_repeat(F.lit(0.0), n - F.size("_p")), values).alias("context"))


def stuck_rows(
    df: DataFrame, key: str | Sequence[str], ts: str, value: str, n: int = 3, stuck_at: float = 0.0,
    *, ties: Sequence[str] = (), block_rows: int = BLOCK_ROWS, chunk_us: int | None = None,
) -> DataFrame:
    """Rows that are at least the n-th in a row equal to ``stuck_at``; NULL breaks a run.

    A row qualifies when it and its n-1 predecessors all equal the value, so a
    bounded row frame is enough and runs of any length need no state.
    """
    hit = F.when(F.col(value) == stuck_at, 1).otherwise(0)
    out = over_rows(
        df, key, ts, lambda w: {"_hits": F.sum(hit).over(w.rowsBetween(-(n - 1), 0))},
        before=n - 1, ties=ties, size=block_rows, size_us=chunk_us)
    return out.where(F.col("_hits") == n).drop("_hits")


def first_values(df: DataFrame, key: str | Sequence[str], ts: str, columns: dict[str, float], ties: Sequence[str] = ()) -> DataFrame:
    """One row per key with each column as in the first row; all-NULL columns give the default.

    A first row that is NULL while later ones are not stays NULL.
    """
    rank = F.struct(ts, *ties)
    keys = as_list(key)
    firsts = df.groupBy(*keys).agg(
        *[F.min_by(F.struct(c), rank).alias(f"_f_{c}") for c in columns],
        *[F.count(c).alias(f"_n_{c}") for c in columns])
    return firsts.select(*keys, *[
        F.when(F.col(f"_n_{c}") == 0, F.lit(d)).otherwise(F.col(f"_f_{c}.{c}")).alias(c) for c, d in columns.items()])


def chronological_split(
    df: DataFrame, key: str | Sequence[str], ts: str, fraction: float = 0.8, ties: Sequence[str] = (), *, chunk_us: int | None = None,
) -> DataFrame:
    """Add ``split`` = train for the first ``int(n * fraction)`` rows of each key, else valid."""
    rows = numbered(df, key, ts, ties, total="_total", size_us=chunk_us)
    cut = F.floor(F.col("_total") * F.lit(fraction))
    return rows.withColumn("split", F.when(F.col("_seq") <= cut, "train").otherwise("valid")).drop("_seq", "_total")


def rolling_rows_mean(
    df: DataFrame, key: str | Sequence[str], order: str, value: str, n: int, name: str, ties: Sequence[str] = (),
) -> DataFrame:
    """Mean of the current and the n-1 previous rows."""
    return over_rows(df, key, order, lambda w: {name: F.avg(value).over(w.rowsBetween(-(n - 1), 0))},
                     before=n - 1, ties=ties)


def first_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """First n rows in order; planned as a bounded top-n, never as a global window."""
    return df.orderBy(*order).limit(n)
