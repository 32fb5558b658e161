"""Whole jobs: extract and export, partition, feature sync, train."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.operators import partition as P
from hetgraph.operators import training as TR
from hetgraph.operators.cut import cut_aware_map
from hetgraph.operators.features import KEY_PREFIX, TTL_SECONDS, as_key_values
from hetgraph.operators.ids import assign_global_ids, attach_global_id, id_ranges, rewrite_edges
from hetgraph.operators.structure import with_reverse
from hetgraph.runtime import materialize, tune
from hetgraph.schema import GraphConfig, TrainConfig
from hetgraph.sinks.keyvalue import Client, write_key_values
from hetgraph.sinks.kv_source import put_key_values
from hetgraph.sinks.store import GraphStore, describe_graph
from hetgraph.sources.tables import TableReader, scan_graph


def export_graph(spark: SparkSession, read: TableReader, config: GraphConfig, dt: str) -> dict:
    """Scan one snapshot, assign global ids, rewrite the edges, write the layout, return its sizes."""
    tune(spark)
    nodes, edges = scan_graph(read, config, dt)
    edge_types = list(config.edge_types)
    if config.with_reverse:
        edges = with_reverse(edges)
        edge_types += [e.reverse() for e in config.edge_types]
    id_map = assign_global_ids(nodes, config.node_types)
    store = GraphStore(spark, config.output_path)
    # Nodes, edges and their description become visible together.
    with store.snapshot():
        # Both come out of joins by node: another exchange, of all vectors and edges, would not lay them out better.
        store.write_nodes(attach_global_id(nodes, id_map), config.node_types, placed=True)
        store.write_edges(rewrite_edges(edges, id_map), edge_types, placed=True)
        stats = store.get_stats()
        dims = stats["feature_dims"]
        # One row per type each.
        node_sizes = id_ranges(id_map).join(
            spark.createDataFrame(
                [(t, n, dims.get(t)) for t, n in stats["node_types"].items()],
                "node_type string, num_nodes long, feature_dim int",
            ),
            "node_type",
        )
        edge_sizes = spark.createDataFrame(
            [(*e, stats["edge_types"][e.name]) for e in edge_types],
            "src_type string, rel string, dst_type string, num_edges long",
        )
        store.write_metadata(
            describe_graph(node_sizes, edge_sizes, config.num_partitions, config.graph_name, config.num_classes)
        )
    return stats


def partition_graph(
    store: GraphStore,
    num_partitions: int,
    method: str = "random",
    hosts: DataFrame | None = None,
    per_host: int = 1,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Partition a stored graph, write it by partition, and report audit and placement."""
    tune(store.spark)
    graph = store.pinned()
    nodes, edges = graph.read_nodes(), graph.read_edges()
    if method in ("balanced", "cut"):
        owner = P.balanced_map(edges, nodes, num_partitions) if method == "balanced" else cut_aware_map(edges, nodes, num_partitions)
        owner = materialize(owner, "owner")
        placed_nodes = nodes.join(owner.drop("weight"), ["node_type", "node_id"])
        placed_edges = P.follow_source(edges, owner.drop("weight"))
    else:
        placed_nodes = P.assign_nodes(nodes, num_partitions, method, seed)
        placed_edges = P.assign_edges(edges, num_partitions, method, seed)
    store.write_partitions(placed_nodes, placed_edges)
    found = store.partition_sizes()
    out = {"audit": P.partition_audit(P.partition_sizes(placed_nodes, placed_edges), found), "sizes": found}
    out["config"] = P.partition_config(found, num_partitions, method, f"{store.root}/parts")
    if hosts is not None:
        parts = found.groupBy("partition_id").agg(F.sum("rows").alias("rows"))
        out["placement"] = P.placement(parts, hosts, per_host)
    return out


def sync_features(
    features: DataFrame, connect: Callable[[], Client], prefix: str = KEY_PREFIX, ttl: int = TTL_SECONDS
) -> int:
    """Send every stored vector to a key-value store; returns the number of keys."""
    return write_key_values(as_key_values(features.where("feature_vec IS NOT NULL"), prefix, ttl), connect)


def sync_features_to(features: DataFrame, root: str, prefix: str = KEY_PREFIX, ttl: int = TTL_SECONDS, at: int = 0) -> None:
    """As ``sync_features``, into the segments of a shared folder and with one commit for all keys."""
    tune(features.sparkSession)
    put_key_values(as_key_values(features.where("feature_vec IS NOT NULL"), prefix, ttl), root, at)


def train_classifier(
    nodes: DataFrame, edges: DataFrame, dim: int, config: TrainConfig, rounds: int = 2, seed: int = 42, **fit
) -> tuple[object, DataFrame]:
    """Fit on the training nodes of the target type and report all three splits."""
    tune(nodes.sparkSession)
    data = TR.graph_features(nodes, edges, dim, rounds, config, seed)
    model = TR.fit_classifier(data.where("train_mask"), **fit)
    return model, TR.evaluate(TR.predict(model, data))


class Trained(NamedTuple):
    model: object
    best_rounds: int
    report: DataFrame  # ``rounds, split`` and the metrics


def train_best(
    nodes: DataFrame, edges: DataFrame, dim: int, config: TrainConfig, max_rounds: int = 2, seed: int = 42, **fit
) -> Trained:
    """Fit with 0..``max_rounds`` rounds of propagation and keep the one best on the validation split.

    The features are built once: those of fewer rounds are their first part.
    """
    tune(nodes.sparkSession)
    data = TR.graph_features(nodes, edges, dim, max_rounds, config, seed)
    models, reports = [], []
    for rounds in range(max_rounds + 1):
        part = data.withColumn("features", F.slice("features", 1, dim * (rounds + 1)))
        model = TR.fit_classifier(part.where("train_mask"), **fit)
        models.append(model)
        reports.append(TR.evaluate(TR.predict(model, part)).select(F.lit(rounds).alias("rounds"), "*"))
    report = materialize(reduce(DataFrame.unionByName, reports), "report")
    scores = report.where("split = 'val'").select(
        F.lit(0).alias("run_id"), F.col("rounds").alias("epoch"), F.col("accuracy").alias("score")
    )
    chosen = TR.best_epoch(scores).first()
    best = chosen.best_epoch if chosen and chosen.best_epoch is not None else 0
    return Trained(models[best], best, report)
