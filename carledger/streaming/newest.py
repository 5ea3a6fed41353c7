"""Newest cells of a stream of puts, kept in state with event-time expiry.

One state value a cell holds its newest put. A put that arrives after a newer one of its cell is passed on as `late`, for a side
table. A cell whose newest put has grown older than the time to live, as the watermark sees it, is passed on as `expired` and
leaves the state. The watermark lags by the allowed delay plus the time to live, so what it drops could not be visible
any more. Puts of a batch are taken in the order of arrival (`seq`), so results don't depend on how the input is cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CELL = ["tbl", "row_key", "family", "qualifier"]
OUTPUT = "tbl string, row_key string, family string, qualifier string, ts bigint, seq bigint, value string, kind string"
_CHANGE = Row(*[c.split()[0] for c in OUTPUT.split(", ")])
STATE = "ts bigint, seq bigint, value string"
#: State with timers needs this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestCell(StatefulProcessor):
    """Timestamps are microseconds; timers and watermarks are milliseconds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        puts = sorted([(r.ts, r.seq, r.value) for r in rows], key=itemgetter(1))
        held = before = self.newest.get()  # None if there is none; every call on the state asks the JVM
        for put in puts:
            if held is None or put[:2] >= held[:2]:
                held = put
            else:
                yield _CHANGE(*key, *put, "late")
        if before is None or held[:2] != before[:2]:
            if before is not None:
                self.handle.deleteTimer(-(-before[0] // 1000))
            self.handle.registerTimer(-(-held[0] // 1000))
            self.newest.update(held)
            yield _CHANGE(*key, *held, "newest")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.newest.get()
        if held is not None:
            self.newest.clear()
            yield _CHANGE(*key, *held, "expired")

    def close(self) -> None:
        pass


def newest_changes(puts: DataFrame, delay_s: int, ttl_s: int) -> DataFrame:
    """The stream of changes (`OUTPUT`) of a stream of puts (cell columns, ts, seq, value)."""
    timed = puts.withColumn("at", F.timestamp_micros("ts")).withWatermark("at", f"{delay_s + ttl_s} seconds")
    return timed.groupBy(*CELL).transformWithState(
        statefulProcessor=NewestCell(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )


def run_to_end(puts: DataFrame, path: str, checkpoint: str, delay_s: int, ttl_s: int) -> DataFrame:
    """Works through what the source holds now and returns all changes written to `path` so far. Run again with the same
    folders, it goes on where it ended."""
    spark = puts.sparkSession
    stored = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        changes = newest_changes(puts, delay_s, ttl_s).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        changes.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", stored)
    return spark.read.schema(OUTPUT).parquet(path)


def visible(changes: DataFrame, horizon: int) -> DataFrame:
    """The newest put of each cell that isn't older than `horizon` (microseconds), from the changes of a stream."""
    newest = changes.filter((F.col("kind") == "newest") & (F.col("ts") >= horizon))
    best = newest.groupBy(*CELL).agg(F.max_by(F.struct("ts", "seq", "value"), F.struct("ts", "seq")).alias("best"))
    return best.select(*CELL, "best.*")


def late(changes: DataFrame, horizon: int) -> DataFrame:
    """The side table: puts that arrived after a newer one of their cell and aren't older than `horizon`."""
    return changes.filter((F.col("kind") == "late") & (F.col("ts") >= horizon)).drop("kind")
