"""Feature writes and deletes as keyed state that expires.

The state holds the last event of every key and an event-time timer that clears it. The watermark trails the newest event by
the time to live: what comes later than that has expired already, so no row that could still count is
dropped, and a timer set at the event's own time fires when the event expires. State lives in RocksDB, so it need not fit
in memory, and is part of the query's checkpoint. What goes out is every change, in order per key; what
is stored now is read from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from hetgraph.operators.features import TTL_SECONDS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Times are microseconds.
STATE = "micros long, event_id long, value string, deleted boolean"
_OUT = f"node_type string, node_id long, {STATE}, change string"


def _change(key: tuple, event: tuple, change: str) -> Row:
    names = ["node_type", "node_id", "micros", "event_id", "value", "deleted", "change"]
    return Row(**dict(zip(names, (*key, *event, change))))


class LastWrite(StatefulProcessor):
    """Keeps the last write of a key by event time, then event id; older ones change nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max(((r.micros, r.event_id, r.value, r.deleted) for r in rows), key=lambda r: r[:2])
        if self.last.exists():
            if tuple(self.last.get())[:2] >= newest[:2]:
                return
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
        self.last.update(newest)
        # The first whole millisecond at which the event has expired.
        self.handle.registerTimer(-(-newest[0] // 1000))
        yield _change(key, newest, "delete" if newest[3] else "put")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            last = tuple(self.last.get())
            self.last.clear()
            if not last[3]:
                yield _change(key, last, "expire")

    def close(self) -> None:
        pass


def feature_changes(writes: DataFrame, ttl: int = TTL_SECONDS) -> DataFrame:
    """The changes that a stream of ``node_type, node_id, ts, event_id, value, deleted`` makes to the store.

    The same columns, and ``change``: put, delete or expire. Rows without a key or a time change nothing.
    """
    writes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = writes.where("node_type IS NOT NULL AND node_id IS NOT NULL AND ts IS NOT NULL").select(
        "node_type",
        "node_id",
        "ts",
        F.unix_micros("ts").alias("micros"),
        F.coalesce("event_id", F.lit(-1).cast("long")).alias("event_id"),
        "value",
        F.coalesce("deleted", F.lit(False)).alias("deleted"),
    )
    changes = (
        rows.withWatermark("ts", f"{ttl} seconds")
        .groupBy("node_type", "node_id")
        .transformWithState(LastWrite(), _OUT, "append", "eventTime")
    )
    return changes.select(
        "node_type", "node_id", F.timestamp_micros("micros").alias("ts"), "event_id", "value", "deleted", "change"
    )


def keep_state(writes: DataFrame, path: str, checkpoint: str, ttl: int = TTL_SECONDS) -> StreamingQuery:
    """Start a query that takes in all rows available now, appends the changes to ``path`` and ends."""
    return (
        feature_changes(writes, ttl)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, checkpoint: str, ttl: int = TTL_SECONDS) -> DataFrame:
    """What is stored at the time of the newest event: ``node_type, node_id, value, ts, event_id, expires_at``."""
    stored = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    rows = stored.select("key.node_type", "key.node_id", "value.*").withColumn("ts", F.timestamp_micros("micros"))
    # The last event of all is in the state, deleted or not; timers lag by up to a millisecond and a batch.
    newest = rows.agg(F.max("ts")).scalar()
    alive = rows.where((F.col("ts") > newest - F.make_interval(secs=F.lit(ttl))) & ~F.col("deleted"))
    return alive.select(
        "node_type", "node_id", "value", "ts", "event_id", (F.col("ts") + F.make_interval(secs=F.lit(ttl))).alias("expires_at")
    )
