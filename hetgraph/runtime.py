"""Session settings, and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: Lists that are told what is written while they are open, see ``recorded``.
_records: list[list[str]] = []


def build_session(name: str = "hetgraph", cpus: int | str = "*", shuffle: int = 8, **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("HETGRAPH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the library relies on; safe to repeat on any session."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where that costs one more exchange after the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Rows of ids take 10 bytes and less in an exchange and 100 to 200 in a task's memory: both bounds are on the former.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
        # Join through a hash table instead of a sort where, at run time, every partition of
        # one side is found to be at most this large. The table can not be spilled.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
        # Lists are collected over sorted rows, one group at a time, and not in a map of groups that is given up when it is full.
        "spark.sql.execution.useObjectHashAggregateExec": "false",
        # Ask for the partitions that a join needs also where the asking side is not broadcast.
        "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly": "false",
    }.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or None
    if configured is None:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="hetgraph-")
    return _local_roots[sc.applicationId]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and return the table read back.

    Cuts the lineage with files that outlive any executor. Being Parquet, later reads prune
    columns, and the planner knows the size of the table.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/hetgraph/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    for paths in _records:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that are materialized inside, for ``drop_tables`` when their readers are done."""
    paths: list[str] = []
    _records.append(paths)
    try:
        yield paths
    finally:
        _records[:] = [r for r in _records if r is not paths]


def drop_tables(spark: SparkSession, paths: Iterable[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete all tables this application has materialized. Call it when their readers are done."""
    drop_tables(spark, [f"{checkpoint_root(spark)}/hetgraph/{spark.sparkContext.applicationId}"])
