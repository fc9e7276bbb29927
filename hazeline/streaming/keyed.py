"""Keyed streaming state: what a station is remembered by from one micro-batch to the next.

Each processor keeps a few values per station in the state store, so a batch
reads and writes the state of the stations it saw and of no others. Timers in
event time act for stations that say nothing more. Times travel as
microseconds since 1970; the rows of one station and micro-batch are sorted in
one task, at 16 bytes a row.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: A missing value, and a missing time, which comes before all others.
NAN, NO_TIME = float("nan"), -(1 << 63)


def with_state_store(spark: SparkSession) -> None:
    """State variables and timers need the RocksDB provider; a session that has another is switched."""
    if not spark.conf.get(PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKSDB)


def micros_of(name: str):
    return F.unix_micros(F.col(name).cast("timestamp"))


def time_of(name: str, kind: T.DataType):
    return F.timestamp_micros(name).cast(kind)


class StuckValues(StatefulProcessor):
    """Rows that are at least the n-th in a row equal to a value, from the last n - 1 rows of their station.

    Old and new rows are ordered by time, then value, NULL first, so a late row
    is judged among the rows that are kept. Columns: us, value, high; rows
    flagged ``high`` are passed on as they are. Rows come and go one by one:
    most stations have few in a micro-batch, and frames would cost more than they hold.
    """

    def __init__(self, key: str, n: int, stuck_at: float):
        self.key, self.n, self.stuck_at = key, n, stuck_at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "us long, value double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        times, values, high = array("q"), array("d"), []
        old = list(self.recent.get())
        for t, v in old:
            times.append(t)
            values.append(NAN if v is None else v)
        for r in rows:
            if r.high:
                high.append(len(times))
            times.append(NO_TIME if r.us is None else r.us)
            values.append(NAN if r.value is None else r.value)
        us, value = np.frombuffer(times, np.int64), np.frombuffer(values)
        order = np.lexsort((np.where(np.isnan(value), -np.inf, value), us))
        last = order[max(len(us) - self.n + 1, 0):].tolist()
        if self.n > 1:
            self.recent.put([(times[i], known(values[i])) for i in last])
        stuck = []
        if len(us) >= self.n:
            hits = np.concatenate([[0], np.cumsum(value[order] == self.stuck_at)])
            stuck = np.sort(order[self.n - 1:][hits[self.n:] - hits[:-self.n] == self.n]).tolist()
        found = Row(self.key, "us", "value", "kind")
        for kind, places in (("stuck", stuck), ("high", high)):
            for i in places:
                if i >= len(old):
                    yield found(key[0], None if times[i] == NO_TIME else times[i], known(values[i]), kind)


def known(value: float) -> float | None:
    return None if value != value else value


class LatestRow(StatefulProcessor):
    """The newest row of a station, until it has been expired for long.

    The last column of the state is the time the row expires. Emits each
    change: the new row, or the row that went, flagged ``expired``.
    """

    def __init__(self, key: str, schema: T.StructType, order: Sequence[str], keep_us: int):
        self.key, self.schema, self.columns, self.order, self.keep_us = key, schema, schema.names, list(order), keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = old = self.latest.get() if self.latest.exists() else None
        for part in rows:
            row = next(part.sort_values(self.order, na_position="first")[self.columns].tail(1).itertuples(index=False, name=None))
            row = tuple(None if pd.isna(v) else v for v in row)
            if best is None or self._rank(row) > self._rank(best):
                best = row
        if best is not old:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # Timers have milliseconds; the row stays until its last microsecond is over.
            self.handle.registerTimer((best[-1] + self.keep_us) // 1000 + 1)
            self.latest.update(best)
            yield self._frame(key, best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.latest.exists():
            yield self._frame(key, self.latest.get(), True)
            self.latest.clear()

    def _rank(self, row: tuple) -> list:
        values = dict(zip(self.columns, row))
        return [(values[c] is not None, values[c]) if values[c] is not None else (False,) for c in self.order]

    def _frame(self, key, row: tuple, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([v], dtype=object) for c, v in zip([self.key, *self.columns, "expired"], (key[0], *row, expired))})


class Silence(StatefulProcessor):
    """Times after which a station said nothing for longer than a gap.

    Only times whose next row is not known to be near are kept, and each is
    decided once the watermark has passed the end of its gap: no row that is
    still accepted could fill it.
    """

    def __init__(self, key: str, gap_us: int):
        self.key, self.gap_us = key, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [r["us"].to_numpy(np.int64) for r in rows]
        return self._decide(key, np.concatenate([*new, self._old()]), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._decide(key, self._old(), timerValues)

    def _old(self) -> np.ndarray:
        return np.array([r[0] for r in self.open.get()], np.int64)

    def _decide(self, key, times: np.ndarray, timerValues) -> Iterator[pd.DataFrame]:
        times = np.unique(times)
        far = np.append(np.diff(times) > self.gap_us, True)[:len(times)]
        times = times[far]
        final = times + self.gap_us < timerValues.getCurrentWatermarkInMs() * 1000
        told, left = times[final], times[~final]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(left):
            self.open.put([(int(t),) for t in left])
            self.handle.registerTimer(int(left[0] + self.gap_us) // 1000 + 1)
        else:
            self.open.clear()
        yield pd.DataFrame({self.key: pd.Series([key[0]] * len(told), dtype=object), "us": told})


def stateful(rows: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType | str, timed: bool, frames: bool = True) -> DataFrame:
    """The processor's output over a stream, by key; it takes and gives pandas frames, or else rows."""
    with_state_store(rows.sparkSession)
    groups = rows.groupBy(key)
    run = groups.transformWithStateInPandas if frames else groups.transformWithState
    return run(processor, schema, "append", "EventTime" if timed else "None")


def state_rows(spark: SparkSession, progress: str, variable: str) -> DataFrame:
    """What a state variable holds after the last finished micro-batch: (key fields, value fields)."""
    kept = spark.read.format("statestore").option("stateVarName", variable).load(progress)
    return kept.select("key.*", f"{'value' if 'value' in kept.columns else 'list_element'}.*")
