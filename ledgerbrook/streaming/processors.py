"""Keyed processors on Spark's own state: running sums and count windows that go on across batches and restarts.

State lives in RocksDB stores that Spark checkpoints as changelogs; there is no other copy of it. The rows of a key in a
batch are put in order by a sort of the key's frame, so the result does not depend on how they arrive; across
batches the order is that of the batches. A key's rows of one batch are in one task's memory: bound a batch with the
source's limits (files, bytes or offsets per trigger). ``operators.ordered`` spreads large keys for tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: The value with nulls as 0, and whether it was null: frames would turn a column of numbers and nulls into floats.
STEP, MISSING = "_step", "_missing"
#: Event time in milliseconds.
AT = "_at"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """RocksDB state for queries started inside; the session's settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB}
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _ordered(frames: Iterator[pd.DataFrame], names: Sequence[str], order: Sequence[str]) -> pd.DataFrame | None:
    """A key's rows of a batch in order; None for a key that only its initial state names.

    ``names`` are those of the stream, since a frame gives some columns names of its own.
    """
    filled = [frame.set_axis(names, axis=1) for frame in frames if len(frame)]
    if not filled:
        return None
    frame = pd.concat(filled, ignore_index=True)
    return frame.sort_values(list(order), kind="stable", na_position="first", ignore_index=True) if order else frame


class RunningSum(StatefulProcessor):
    """Rows in; the same rows with the total of their key so far out."""

    def __init__(self, names: Sequence[str], order: Sequence[str], out: Sequence[str], value: str, total: str):
        self.names, self.order, self.out, self.value, self.total = names, order, list(out), value, total

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sum = handle.getValueState("sum", "total bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        before = self.sum.get()[0] if self.sum.exists() else 0
        self.sum.update((before + int(initialState[STEP].sum()),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.sum.get()[0] if self.sum.exists() else 0
        frame = _ordered(rows, self.names, self.order)
        if frame is None:
            return
        sums = before + frame[STEP].cumsum()
        self.sum.update((int(sums.iloc[-1]),))
        frame[self.value] = pd.array(frame[STEP], "Int64")
        frame.loc[frame[MISSING], self.value] = pd.NA
        yield frame.assign(**{self.total: sums})[[*self.out, self.total]]

    def close(self) -> None:
        pass


class CountWindowAverage(StatefulProcessor):
    """Rows in; the key and the truncated average out after every ``size`` rows of the key.

    What is kept of an open window is cleared once it is full. With ``ttl`` milliseconds it is also forgotten
    when the watermark passes the key's last row by that much: a timer per key, moved on by every batch with rows.
    """

    def __init__(self, names: Sequence[str], order: Sequence[str], key_name: str, size: int = 2, ttl: int | None = None):
        self.names, self.order, self.key_name, self.size, self.ttl = names, order, key_name, size, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "filled bigint, total bigint, until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        filled, total, until = self.window.get() if self.window.exists() else (0, 0, None)
        frame = _ordered(rows, self.names, self.order)
        if frame is None:
            return
        values = frame[STEP].to_numpy()
        full, left = divmod(filled + len(values), self.size)
        # Sums up to the end of each window; what was carried in counts for the first one.
        upto = np.concatenate(([0], total + np.cumsum(values)))
        ends = upto[np.arange(1, full + 1) * self.size - filled]
        sums = np.diff(ends, prepend=0)
        if until is not None:
            self.handle.deleteTimer(until)
        if left:
            until = int(frame[AT].max()) + self.ttl if self.ttl else None
            if until is not None:
                self.handle.registerTimer(until)
            self.window.update((left, int(upto[-1] - (ends[-1] if full else 0)), until))
        else:
            self.window.clear()
        averages = np.where(sums >= 0, 1, -1) * (np.abs(sums) // self.size)
        if full:
            yield pd.DataFrame({self.key_name: [key[0]] * full, "average": averages.astype("int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.window.clear()
        yield from ()

    def close(self) -> None:
        pass


def _stepped(df: DataFrame, value: str, *columns: str | Column) -> DataFrame:
    step = F.coalesce(F.col(value).cast("bigint"), F.lit(0))
    return df.select(*columns, step.alias(STEP), F.col(value).isNull().alias(MISSING))


def running_sums(
    stream: DataFrame, key: str, order: Sequence[str], value: str, initial: DataFrame | None = None, total: str = "running_sum"
) -> DataFrame:
    """The stream's rows with the running sum of their key; a null value counts as 0.

    ``initial`` (key, value) starts the sums, also those of keys that come much later. It is read in the first batch.
    """
    others = [c for c in stream.columns if c != value]
    rows = _stepped(stream, value, *others)
    seeds = None if initial is None else _stepped(initial, value, key).groupBy(key)
    fields = [T.StructField(c, T.LongType()) if c == value else stream.schema[c] for c in stream.columns]
    schema = T.StructType([*fields, T.StructField(total, T.LongType())])
    processor = RunningSum(rows.columns, order, stream.columns, value, total)
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", "None", seeds)


def count_window_averages(
    stream: DataFrame, key: str, order: Sequence[str], value: str, size: int = 2,
    ttl: tuple[str, int] | None = None, delay: str = "0 seconds",
) -> DataFrame:
    """(key, truncated average) after every ``size`` values of a key, across batches; a null value counts as 0.

    ``ttl`` names the column of event times and how many seconds a window may wait for its next value. Rows
    later than the watermark, which trails by ``delay``, are dropped then.
    """
    schema = T.StructType([stream.schema[key], T.StructField("average", T.LongType())])
    names = dict.fromkeys([key, *order])
    if ttl is None:
        rows, mode = _stepped(stream, value, *names), "None"
    else:
        marked = stream.withColumn(ttl[0], F.col(ttl[0]).cast("timestamp")).withWatermark(ttl[0], delay)
        at = F.unix_millis(ttl[0]).alias(AT)
        rows, mode = _stepped(marked, value, *dict.fromkeys([*names, ttl[0]]), at), "EventTime"
    processor = CountWindowAverage(rows.columns, order, key, size, ttl and ttl[1] * 1000)
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "Append", mode)
