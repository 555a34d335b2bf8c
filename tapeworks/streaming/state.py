"""Streams with state for each key that outlives any window: first rows, latest rows.

State is kept by the RocksDB provider, so it is bounded by disks and not by memory, and comes back from the checkpoint
after a restart. ``rocksdb`` sets the provider; a query keeps the one that it began with.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state with the RocksDB provider."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def local(value: object) -> object:
    """Times without a zone, in the worker's, so that those from rows and from state compare."""
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone().replace(tzinfo=None)
    return tuple(map(local, value)) if isinstance(value, tuple) else value


class First(StatefulProcessor):
    """Lets the first row of each key through; with ``forget`` milliseconds, keys that were quiet for so long in event time are new again."""

    def __init__(self, columns: list[str], time: int | None, forget: int | None):
        self.columns, self.time, self.forget = columns, time, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", StructType([StructField("until", LongType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        known = self.seen.exists()
        until = self.seen.get()[0] if known else 0
        earliest, reach = None, until
        for r in rows:
            at = int(r[self.time].timestamp() * 1000) if self.time is not None and r[self.time] is not None else 0
            if earliest is None or at < earliest[1]:
                earliest = (r, at)
            reach = max(reach, at + (self.forget or 0))
        if self.forget is not None and reach > until:
            if known:
                self.handle.deleteTimer(until)
            self.handle.registerTimer(reach)
        if not known or (self.forget is not None and reach > until):
            self.seen.update((reach,))
        if not known:
            yield Row(**{c: earliest[0][c] for c in self.columns})

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:  # noqa: N802, N803
        self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


class Latest(StatefulProcessor):
    """Keeps the row of the greatest order for each key and gives it out whenever it changes."""

    def __init__(self, schema: StructType, order: str):
        self.schema, self.order = schema, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", self.schema)

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        names = self.schema.fieldNames()
        at = names.index(self.order)
        best = tuple(self.best.get()) if self.best.exists() else None
        greatest = None if best is None else local(best[at])
        changed = False
        for r in rows:
            order = local(r[names[at]])
            if best is None or greatest is None or (order is not None and order > greatest):
                best, greatest, changed = tuple(r[c] for c in names), order, True
        if changed:
            self.best.update(best)
            yield Row(**dict(zip(names, best, strict=True)))

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, key: str, time: str | None = None, forget_ms: int | None = None) -> DataFrame:
    """The first row of each key over any time (append mode).

    Within a micro-batch that brings a new key its first row in any order counts, with ``time`` the earliest. With ``forget_ms`` the state of a key
    is dropped once the watermark is that far beyond its last row, so state doesn't grow for ever; ``stream`` then has a watermark on ``time``.
    """
    if forget_ms is not None and time is None:
        raise ValueError("forgetting takes a time column")
    mode = "None" if forget_ms is None else "EventTime"
    at = stream.columns.index(time) if time else None
    made = First(stream.columns, at, forget_ms)
    return stream.groupBy(key).transformWithState(statefulProcessor=made, outputStructType=stream.schema, outputMode="Append", timeMode=mode)


def latest_rows(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Each key's row of the greatest ``order`` whenever it changes (update mode); null orders count least, of equal ones the first stays."""
    return stream.groupBy(key).transformWithState(statefulProcessor=Latest(stream.schema, order), outputStructType=stream.schema, outputMode="Update", timeMode="None")


def latest_of_updates(updates: DataFrame, key: str, order: str) -> DataFrame:
    """A batch table of updates, as ``latest_rows`` wrote them, as one row a key."""
    rest = [c for c in updates.columns if c != key]
    best = updates.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order)).alias("row_"))
    return best.select(*(F.col(key) if c == key else F.col(f"row_.{c}").alias(c) for c in updates.columns))
