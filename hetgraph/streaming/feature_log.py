"""Feature writes and deletes as a stream into an append-only log.

The stream only appends, so it needs no state and no merge of the table per batch. Which write
counts is decided by event time when the log is read, which makes late rows harmless. A
compaction keeps the log as small as the number of keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG_SCHEMA = "node_type string, node_id long, ts timestamp, event_id long, value string, deleted boolean"
LOG_COLUMNS = ["node_type", "node_id", "ts", "event_id", "value", "deleted"]


def append_log(writes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start a query that appends all rows available now and then ends."""
    return (
        writes.select(*LOG_COLUMNS)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def compact_log(log: DataFrame, path: str, before: str) -> DataFrame:
    """Write a new log that keeps, of the events up to ``before``, only the last one per key.

    Later events stay as they are, so any state at ``before`` or after it reads the same.
    """
    cut = F.to_timestamp(F.lit(before))
    old = log.where(F.col("ts") <= cut)
    last = old.groupBy("node_type", "node_id").agg(
        F.max_by(F.struct("ts", "event_id", "value", "deleted"), F.struct("ts", "event_id")).alias("e")
    )
    kept = last.select("node_type", "node_id", "e.*").unionByName(log.where(F.col("ts") > cut).select(*LOG_COLUMNS))
    kept.write.mode("errorifexists").parquet(path)
    return read_log(log.sparkSession, path)
