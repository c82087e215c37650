"""Resumable work on a stream: what each key has already met, and which keys are done, as state with timers and expiry.

The state lives in the stream's checkpoint, so that a stream that was stopped,
or lost its executors, goes on where it was: nothing is told twice, nothing is
missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "key string, kind string, item string, ord long, n_items long"


class DoneLog(StatefulProcessor):
    """One key: a value (how many items, at which ``ord`` it was closed) and a map of items to the first ``ord`` of each.

    Each item of a key is told once, as ``item``. An item of ``closing`` ends the
    work on the key: it is told as ``done`` and its map is dropped; later rows of
    it are nothing new. A key without a row for ``idle_ms`` of event time is told
    as ``idle`` and forgotten. Items that are not met again for ``ttl_ms`` of
    processing time are forgotten.
    """

    def __init__(self, closing: frozenset[str], idle_ms: int | None, ttl_ms: int | None) -> None:
        self.closing, self.idle_ms, self.ttl_ms = closing, idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.about = handle.getValueState("about", "n_items long, closed long")
        self.items = handle.getMapState("items", "item string", "ord long", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, closed = (int(x) for x in self.about.get()) if self.about.exists() else (0, -1)
        first: dict[str, int] = {}
        for part in rows:  # a batch's rows come in any order: of each item the first counts
            for item, o in part.groupby("item")["ord"].min().items():
                first[item] = min(int(o), first.get(item, int(o)))
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self.idle_ms)
        if closed >= 0:
            return
        ends = [o for item, o in first.items() if item in self.closing]
        end = min(ends, default=None)
        told, met = [], n  # each call to the state is a message to the JVM: none for a new key's map, none for a map that is dropped at once
        for item, o in sorted(first.items(), key=lambda x: x[1]):
            if (end is None or o <= end) and not (met and self.items.containsKey((item,))):
                if end is None:
                    self.items.updateValue((item,), (o,))
                n += 1
                told.append((key[0], "item", item, o, n))
        if end is not None:
            told.append((key[0], "done", None, end, n))
            if met:
                self.items.clear()
        self.about.update((n, -1 if end is None else end))
        if told:
            yield pd.DataFrame(told, columns=["key", "kind", "item", "ord", "n_items"])

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.about.update((int(row["n_items"]), -1 if pd.isna(row["closed"]) else int(row["closed"])))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, closed = (int(x) for x in self.about.get()) if self.about.exists() else (0, -1)
        self.about.clear()
        self.items.clear()
        yield pd.DataFrame([(key[0], "idle", None, closed, n)], columns=["key", "kind", "item", "ord", "n_items"])

    def close(self) -> None:
        pass


def firsts(rows: DataFrame, timed: bool) -> DataFrame:
    """Of a task's rows of a batch the first of each key and item, so that a busy key is few rows when it is dealt out."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            by = p.groupby(["key", "item"], sort=False)
            out = by["ord"].min().reset_index()
            yield out.assign(ts=by["ts"].max().to_numpy()) if timed else out

    return rows.mapInPandas(run, rows.schema)


def done_log(
    rows: DataFrame, key: str, item: str, order: str, closing: list[str], time: str | None = None, idle: str | None = None, ttl_ms: int | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """What a stream of rows brings that is new: key, kind (``item``, ``done``, ``idle``), item, ord, n_items.

    ``order`` is a long that grows along the stream; rows within a batch may come in
    any order. Rows with a null key, item or order tell nothing. With ``time`` and
    ``idle`` (an interval), keys that are quiet for so long after the watermark are
    told and forgotten. ``known`` (key, n_items, closed) is what a log that was
    saved elsewhere holds: keys closed there stay done, others count on.
    """
    timed = time is not None and idle is not None
    narrow = rows.select(F.col(key).cast("string").alias("key"), F.col(item).cast("string").alias("item"), F.col(order).cast("long").alias("ord"), *([F.col(time).alias("ts")] if timed else []))
    narrow = narrow.where("key is not null and item is not null and ord is not null")
    narrow = firsts(narrow, timed)
    if timed:
        narrow = narrow.withWatermark("ts", "0 seconds")
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if timed else None
    mode = "EventTime" if timed else "ProcessingTime" if ttl_ms else "None"
    start = None if known is None else known.select(F.col("key").cast("string").alias("key"), F.col("n_items").cast("long").alias("n_items"), F.col("closed").cast("long").alias("closed")).groupBy("key")
    return narrow.groupBy("key").transformWithStateInPandas(DoneLog(frozenset(closing), idle_ms, ttl_ms), OUT, "Append", mode, start)


def saved_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state that a stopped log has saved: key, n_items, closed (-1 if it is not done). It may start another log as ``known``."""
    held = spark.read.format("statestore").option("stateVarName", "about").load(checkpoint)
    return held.select(F.col("key.key").alias("key"), F.col("value.n_items").alias("n_items"), F.col("value.closed").alias("closed"))


def run_log(told: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Start, or go on with, a log that adds to ``table`` exactly once what is in the stream now."""
    spark: SparkSession = told.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # the store that holds several states; the query keeps the setting it was started with
    try:
        return told.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)
