"""Feature store: keys, values, lookups, and a log in which the last write per key wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_PREFIX = "gnn:feat"
TTL_SECONDS = 86_400
DEFAULT_DIM = 256


def feature_key(node_type="node_type", node_id="node_id", prefix: str = KEY_PREFIX) -> Column:
    return F.concat_ws(":", F.lit(prefix), F.col(node_type), F.col(node_id).cast("string"))


def encode_vector(vec: str | Column) -> Column:
    """Vector as JSON text."""
    return F.to_json(F.col(vec) if isinstance(vec, str) else vec)


def decode_vector(text: str | Column) -> Column:
    return F.from_json(F.col(text) if isinstance(text, str) else text, "array<float>")


def as_key_values(features: DataFrame, prefix: str = KEY_PREFIX, ttl: int = TTL_SECONDS) -> DataFrame:
    """``key, ttl, value`` rows as a key-value store takes them."""
    return features.select(
        feature_key(prefix=prefix).alias("key"), F.lit(ttl).alias("ttl"), encode_vector("feature_vec").alias("value")
    )


def get_feature(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Requests with their vector, null when there is none; order columns and duplicates stay.

    The features are first reduced to the requested keys: however large the table of vectors is,
    only those rows are shuffled, and none but the keys if Spark finds these small enough to send.
    """
    keys = ["node_type", "node_id"]
    known = features.select(*keys, "feature_vec")
    if not requests.isStreaming:
        known = known.join(requests.select(*keys).distinct(), keys, "left_semi")
    return requests.join(known, ["node_type", "node_id"], "left")


def get_features(requests: DataFrame, features: DataFrame, default_dim: int = DEFAULT_DIM) -> DataFrame:
    """As ``get_feature``, with a zero vector in place of a missing one."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), default_dim)
    return get_feature(requests, features).withColumn("feature_vec", F.coalesce("feature_vec", zeros))


def latest_features(log: DataFrame, now: str | Column, ttl: int = TTL_SECONDS) -> DataFrame:
    """State of the store at ``now``: per key the last write, unless deleted or expired.

    ``log`` has ``node_type, node_id, ts, event_id, value`` and optionally ``deleted``. Event
    time decides, so late rows lose however they arrive. Writes after ``now`` are not seen.
    Every event is combined on the map side: a hot key costs one row per task. A write that is
    older than the TTL is dead whether or not others follow, so both bounds on ``ts`` reach the scan.
    """
    at = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    deleted = F.col("deleted") if "deleted" in log.columns else F.lit(False)
    alive = F.col("ts") > at - F.make_interval(secs=F.lit(ttl))
    last = (
        log.where((F.col("ts") <= at) & alive)
        .groupBy("node_type", "node_id")
        .agg(
            F.max_by(
                F.struct("ts", "event_id", "value", deleted.alias("deleted")), F.struct("ts", "event_id")
            ).alias("e")
        )
        .select("node_type", "node_id", "e.*")
    )
    return last.where(~F.col("deleted")).select(
        "node_type",
        "node_id",
        "value",
        "ts",
        "event_id",
        (F.col("ts") + F.make_interval(secs=F.lit(ttl))).alias("expires_at"),
    )


def feature_stats(key_values: DataFrame) -> DataFrame:
    """Keys and bytes of text per node type."""
    return key_values.groupBy(F.split_part("key", F.lit(":"), F.lit(-2)).alias("node_type")).agg(
        F.count(F.lit(1)).alias("num_keys"), F.sum(F.length("value")).alias("value_chars")
    )
