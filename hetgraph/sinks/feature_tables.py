"""Feature vectors kept in buckets of their key.

A bucketed table is dealt by ``(node_type, node_id)`` when it is written. A lookup then brings the
requested keys to the buckets; the vectors are read where they lie and never exchanged. The table is a folder of Parquet
files; its layout stands in a small table of the catalog, which ``open_features`` makes anew in a session that does not know it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.operators.features import DEFAULT_DIM

KEYS = ["node_type", "node_id"]
SCHEMA = "node_type STRING, node_id BIGINT, feature_vec ARRAY<FLOAT>"


def write_features(features: DataFrame, path: str, buckets: int = 200) -> None:
    """Write ``node_type, node_id, feature_vec`` to an empty folder; rows without a vector or a key are left out.

    One exchange by key brings each bucket together, so that there is one sorted file per bucket. The number of buckets is that of
    the tasks of every later lookup: about 128 MB each.
    """
    name = f"features_{uuid.uuid4().hex}"
    rows = features.select(*KEYS, "feature_vec").where("node_type IS NOT NULL AND node_id IS NOT NULL AND feature_vec IS NOT NULL")
    dealt = rows.repartition(buckets, *KEYS)
    dealt.write.bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).format("parquet").saveAsTable(name)
    # The files stay: the table is an external one.
    features.sparkSession.sql(f"DROP TABLE {name}")


def open_features(spark: SparkSession, path: str, buckets: int = 200) -> DataFrame:
    """The table that ``write_features`` wrote with as many buckets."""
    name = f"features_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({SCHEMA}) USING parquet LOCATION '{place}' "
        f"CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(KEYS)}) INTO {buckets} BUCKETS"
    )
    return spark.table(name)


def lookup(requests: DataFrame, stored: DataFrame, default_dim: int = DEFAULT_DIM) -> DataFrame:
    """Requests with their vector, a zero vector where there is none; order columns and duplicates stay.

    Distinct keys go to the buckets, so a key that a third of all requests ask for is looked up once.
    """
    keys = requests.select(*KEYS).where("node_type IS NOT NULL AND node_id IS NOT NULL").distinct()
    found = stored.join(keys, KEYS, "left_semi")
    zeros = F.array_repeat(F.lit(0.0).cast("float"), default_dim)
    return requests.join(found, KEYS, "left").withColumn("feature_vec", F.coalesce("feature_vec", zeros))


def bucket_sizes(stored: DataFrame, buckets: int = 200) -> DataFrame:
    """Vectors per bucket, to see whether the number of buckets fits."""
    bucket = F.pmod(F.hash(*KEYS), F.lit(buckets)).alias("bucket")
    return stored.groupBy(bucket).agg(F.count(F.lit(1)).alias("vectors"))
