"""Streaming forms of the daily jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.upsert import upsert_patches
from ..sources.keyed import KeyedTable


def run(items: DataFrame, checkpoint: str, each) -> StreamingQuery:
    return items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()


def stream_upsert(items: DataFrame, checkpoint: str, latest: KeyedTable, history: KeyedTable, key: str, day: str, seq: str, status: str, fields: Sequence[str], present: str | None = None) -> StreamingQuery:
    """Every micro-batch patches the table of latest states and the daily history, in the buckets that its keys fall in.

    A batch goes by the checkpoint's name and its number: when it runs again after a stop, what it has merged already is left alone. ``history`` is keyed by key and day and may be parted
    by day, so that a batch of today does not touch older days.
    """
    def merge(df: DataFrame, batch: int) -> None:
        token = f"{checkpoint}#{batch}"
        df = df.persist()
        try:
            latest.merge(token, df, lambda base, new: upsert_patches(base, new, [key], seq, status, fields, present))
            history.merge(token, df, lambda base, new: upsert_patches(base, new, [key, day], seq, status, fields, present, keep_deal=False))
        finally:
            df.unpersist()

    return run(items, checkpoint, merge)


def append_to(path: str):
    """Sink of a table that only grows: each batch has its own folder, so a batch that runs again adds nothing."""
    return lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def slot_counts(items: DataFrame, ts: str, *keys: str, late: str = "1 day") -> DataFrame:
    """Rows per day and keys, given out once a day can get no more rows."""
    days = items.withWatermark(ts, late).groupBy(F.window(ts, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return days.select(F.to_date("window.start").alias("day"), *keys, "n")


def request_dedup(requests: DataFrame, ts: str, keys: Sequence[str], late: str = "1 day") -> DataFrame:
    """The first of repeated requests; state is kept for ``late`` only."""
    return requests.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


class SeenInRun(StatefulProcessor):
    """Lets the first row of every run of a listing through. The state of a listing is one number, its newest run; a timer clears it ``idle`` after the listing's last row."""

    def __init__(self, run: str, ts: str, idle: timedelta):
        self.run, self.ts, self.idle = run, ts, int(idle.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", StructType([StructField("run", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the interface
        held = self.newest.get()
        held, first, last = held[0] if held else None, None, None
        for pdf in rows:
            last = pdf[self.ts].max() if last is None else max(last, pdf[self.ts].max())
            new = pdf[pdf[self.run].notna() if held is None else pdf[self.run] > held]
            first = (new if first is None else pd.concat([first, new])).sort_values([self.run, self.ts], kind="stable").drop_duplicates(self.run)
        if first is not None and len(first):
            self.newest.update((int(first[self.run].max()),))
            yield first
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if pd.notna(last):
            self.handle.registerTimer(int(last.timestamp() * 1000) + self.idle)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def unseen(items: DataFrame, key: str, run: str, ts: str, idle: timedelta = timedelta(days=2), late: str = "1 day") -> DataFrame:
    """The first row of every listing in each run (a number that grows from run to run), so that a detail page is asked for once a run.

    A row of a run older than the listing's newest one, or of none, is not let through. State is one number per listing that had a row in the last ``idle`` of event time (and the
    watermark's ``late``), whatever number of runs; a listing that comes again later is let through anew. Start it under ``rocksdb_state``.
    """
    made = items.withWatermark(ts, late).groupBy(key)
    return made.transformWithStateInPandas(SeenInRun(run, ts, idle), items.schema, "Append", "EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, on the executors' disks, as state with timers must be."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
