"""Scans of node, edge and embedding tables in a catalog, and of feature files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.schema import EDGE_SCHEMA, NODE_SCHEMA, EdgeType, GraphConfig, conform

# How a table name becomes a DataFrame; ``spark.table`` unless the caller has its own tables.
TableReader = Callable[[str], DataFrame]


def table_reader(spark: SparkSession, database: str) -> TableReader:
    return lambda name: spark.table(f"{database}.{name}")


def scan_nodes(table: DataFrame, node_type: str, dt: str) -> DataFrame:
    """One snapshot of one node type: ``node_type, node_id, feature_vec, label``."""
    day = conform(table, NODE_SCHEMA, optional=("feature_vec", "label")).where(F.col("dt") == dt)
    kept = [c for c in ("feature_vec", "label") if c in day.columns]
    return day.select(F.lit(node_type).alias("node_type"), "node_id", *kept)


def scan_edges(table: DataFrame, etype: EdgeType, dt: str) -> DataFrame:
    """One snapshot of one edge type: ``src_type, rel, dst_type, src, dst[, edge_weight]``.

    One physical table may hold several pairs of end types, so these are predicates too.
    """
    etype = EdgeType(*etype)
    day = conform(table, EDGE_SCHEMA, optional=("edge_weight",)).where(
        (F.col("dt") == dt) & (F.col("src_type") == etype.src_type) & (F.col("dst_type") == etype.dst_type)
    )
    kept = [c for c in ("edge_weight",) if c in day.columns]
    return day.select(
        "src_type",
        F.lit(etype.rel).alias("rel"),
        "dst_type",
        F.col("src_node_id").alias("src"),
        F.col("dst_node_id").alias("dst"),
        *kept,
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_all_nodes(read: TableReader, node_types: Sequence[str], dt: str) -> DataFrame:
    """All node types in one long table."""
    return _union([scan_nodes(read(f"nodes_{t}"), t, dt) for t in node_types])


def scan_all_edges(read: TableReader, edge_types: Sequence[EdgeType], dt: str) -> DataFrame:
    """All edge types in one long table."""
    return _union([scan_edges(read(f"edges_{EdgeType(*e).rel}"), e, dt) for e in edge_types])


def scan_graph(read: TableReader, config: GraphConfig, dt: str) -> tuple[DataFrame, DataFrame]:
    return scan_all_nodes(read, config.node_types, dt), scan_all_edges(read, config.edge_types, dt)


def node_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("num_nodes"))


def edge_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src_type", "rel", "dst_type").agg(F.count(F.lit(1)).alias("num_edges"))


def scan_embeddings(
    table: DataFrame, node_type: str, id_col: str = "node_id", feature_col: str = "embedding_vec"
) -> DataFrame:
    """Ids and vectors of one node type out of an embedding table."""
    return table.where(F.col("node_type") == node_type).select(
        F.lit(node_type).alias("node_type"),
        F.col(id_col).cast("long").alias("node_id"),
        F.col(feature_col).cast("array<float>").alias("feature_vec"),
    )


def read_feature_files(
    spark: SparkSession, path: str, node_type: str, id_col: str = "node_id", feature_col: str = "feat"
) -> DataFrame:
    """Ids and vectors of one node type out of Parquet files."""
    return spark.read.parquet(path).select(
        F.lit(node_type).alias("node_type"),
        F.col(id_col).cast("long").alias("node_id"),
        F.col(feature_col).cast("array<float>").alias("feature_vec"),
    )
