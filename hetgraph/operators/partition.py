"""Node partitions, edges that follow them, halos, cuts, balance and placement."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.functions.hashing import hash52
from hetgraph.operators.ids import distinct_nodes, with_row_index, with_running_total
from hetgraph.runtime import materialize


def _by_hash(node_type: Column, node_id: Column, n: int, seed: int) -> Column:
    return F.pmod(F.hash(node_id), F.lit(n))


def _by_random(node_type: Column, node_id: Column, n: int, seed: int) -> Column:
    return F.pmod(hash52(seed, node_type, node_id), F.lit(n))


def _by_mod(node_type: Column, node_id: Column, n: int, seed: int) -> Column:
    return F.pmod(node_id, F.lit(n))


METHODS = {"hash": _by_hash, "random": _by_random, "mod": _by_mod}


def partition_of(node_type, node_id, n: int, method: str = "random", seed: int = 42) -> Column:
    """Partition of a node as a function of its key, so no table is needed to find it."""
    if method not in METHODS:
        raise ValueError(f"unknown partition method {method!r}; known: {sorted(METHODS)}")
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return METHODS[method](as_col(node_type), as_col(node_id), n, seed).cast("int")


def assign_nodes(nodes: DataFrame, n: int, method: str = "random", seed: int = 42) -> DataFrame:
    return nodes.withColumn("partition_id", partition_of("node_type", "node_id", n, method, seed))


def assign_edges(edges: DataFrame, n: int, method: str = "random", seed: int = 42) -> DataFrame:
    """Edges go with their source. The rule is computed on the edge itself: no join."""
    return edges.withColumn("partition_id", partition_of("src_type", "src", n, method, seed))


def follow_source(edges: DataFrame, partition_map: DataFrame) -> DataFrame:
    """Edges go with their source under a given ``node_type, node_id, partition_id`` map.

    An edge whose source the map does not hold has no place; ``unplaced_edges`` counts those.
    """
    owner = partition_map.select(
        F.col("node_type").alias("src_type"), F.col("node_id").alias("src"), "partition_id"
    )
    return edges.join(owner, ["src_type", "src"])


def unplaced_edges(edges: DataFrame, partition_map: DataFrame) -> DataFrame:
    """Edges per type whose source is not in the map."""
    known = partition_map.select(F.col("node_type").alias("src_type"), F.col("node_id").alias("src"))
    lost = edges.join(known, ["src_type", "src"], "left_anti")
    return lost.groupBy("src_type", "rel", "dst_type").agg(F.count(F.lit(1)).alias("edges"))


def balanced_map(edges: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """Partition map whose parts hold about the same number of edge ends.

    Nodes are taken in id order and cut where the running total of their degrees passes each
    n-th part. A node without edges counts one so that it moves the cut as well.
    """
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src_type").alias("node_type"), F.col("src").alias("node_id")),
                F.struct(F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id")),
            )
        )
    )
    weight = ends.groupBy("node_type", "node_id").agg(F.count(F.lit(1)).alias("weight"))
    weighted = (
        nodes.select("node_type", "node_id")
        .distinct()
        .join(weight, ["node_type", "node_id"], "left")
        .withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
    )
    placed, total = with_running_total(weighted, ["node_type", "node_id"], "weight", "__before")
    part = F.floor(F.col("__before") * n / F.lit(max(total, 1))).cast("int")
    return placed.select("node_type", "node_id", "weight", part.alias("partition_id"))


def partition_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes per partition and type and edges per partition and edge type, in one table."""
    node_part = nodes.groupBy("partition_id", F.lit("node").alias("kind"), F.col("node_type").alias("name")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    edge_part = edges.groupBy(
        "partition_id", F.lit("edge").alias("kind"), F.concat_ws("__", "src_type", "rel", "dst_type").alias("name")
    ).agg(F.count(F.lit(1)).alias("rows"))
    return node_part.unionByName(edge_part)


PARTITION_CONFIG = (
    "graph_name string, num_parts int, part_method string, part_path string, "
    "num_nodes map<string,bigint>, partition_stats array<struct<partition_id:int,"
    "num_nodes:map<string,bigint>,num_edges:map<string,bigint>>>"
)


def partition_config(sizes: DataFrame, num_parts: int, method: str, path: str, graph_name: str = "hetero_graph") -> DataFrame:
    """One JSON text that describes a partitioning, out of its ``partition_sizes``.

    ``sizes`` has a row per partition and type, so all of it fits one row.
    """

    def per_name(kind):
        entry = F.struct(F.col("name").alias("key"), F.col("rows").alias("value"))
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, entry))))

    parts = sizes.groupBy("partition_id").agg(per_name("node").alias("num_nodes"), per_name("edge").alias("num_edges"))
    stats = parts.groupBy().agg(
        F.array_sort(
            F.collect_list(F.struct("partition_id", "num_nodes", "num_edges")),
            lambda a, b: a["partition_id"] - b["partition_id"],
        ).alias("partition_stats")
    )
    totals = (
        sizes.where("kind = 'node'")
        .groupBy("name")
        .agg(F.sum("rows").alias("rows"))
        .groupBy()
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "rows")))).alias("num_nodes"))
    )
    return stats.select(
        F.to_json(
            F.struct(
                F.lit(graph_name).alias("graph_name"),
                F.lit(num_parts).alias("num_parts"),
                F.lit(method).alias("part_method"),
                F.lit(path).alias("part_path"),
                totals.scalar().alias("num_nodes"),
                "partition_stats",
            )
        ).alias("config")
    )


def _owned_edges(edges: DataFrame, owner: DataFrame) -> DataFrame:
    """Edges with the partition of either end under a given map."""
    far = owner.select(F.col("node_type").alias("dst_type"), F.col("node_id").alias("dst"), F.col("partition_id").alias("owner_id"))
    return follow_source(edges, owner).join(far, ["dst_type", "dst"])


def _ruled_edges(edges: DataFrame, n: int, method: str, seed: int) -> DataFrame:
    return assign_edges(edges, n, method, seed).withColumn("owner_id", partition_of("dst_type", "dst", n, method, seed))


def halo_nodes(edges: DataFrame, n: int = 0, method: str = "random", seed: int = 42, owner: DataFrame | None = None) -> DataFrame:
    """Per partition, the ends of its edges that another partition owns.

    Either a rule gives the partitions, or ``owner``, a map as ``follow_source`` takes it.
    """
    placed = _ruled_edges(edges, n, method, seed) if owner is None else _owned_edges(edges, owner)
    return (
        placed.where("partition_id <> owner_id")
        .select(
            "partition_id",
            F.col("dst_type").alias("node_type"),
            F.col("dst").alias("node_id"),
            "owner_id",
        )
        .distinct()
    )


def edge_cut(edges: DataFrame, n: int = 0, method: str = "random", seed: int = 42, owner: DataFrame | None = None) -> DataFrame:
    """Edges whose ends live apart, per edge type, under a rule or under the map ``owner``."""
    placed = _ruled_edges(edges, n, method, seed) if owner is None else _owned_edges(edges, owner)
    return placed.groupBy("src_type", "rel", "dst_type").agg(
        F.count(F.lit(1)).alias("num_edges"), F.count_if(F.col("partition_id") != F.col("owner_id")).alias("cut_edges")
    ).withColumn("cut_ratio", F.col("cut_edges") / F.col("num_edges"))


def cut_totals(edges: DataFrame, owners: dict[str, DataFrame]) -> DataFrame:
    """One row: for each named map the number of edges whose ends live apart. All maps must hold the same nodes; the edges
    meet them together."""
    key = ["node_type", "node_id"]
    named = [o.select(*key, F.col("partition_id").alias(name)) for name, o in owners.items()]
    held = reduce(lambda a, b: a.join(b, key), named).select(*key, F.struct(*owners).alias("partition_id"))
    apart = [F.count_if(F.col(f"partition_id.{name}") != F.col(f"owner_id.{name}")).alias(name) for name in owners]
    return _owned_edges(edges, held).agg(*apart)


class LocalGraph(NamedTuple):
    """A partitioned graph in which every partition names its nodes by itself.

    ``members``: ``partition_id, node_type, local_id, node_id, owner_id``, the map back. ``nodes``: the columns of the nodes
    that a partition owns, by ``local_id``. ``edges``: its edges between local ids, with all their other columns.
    """

    members: DataFrame
    nodes: DataFrame
    edges: DataFrame


def local_graph(nodes: DataFrame, edges: DataFrame, n: int, method: str = "random", seed: int = 42) -> LocalGraph:
    """Number the nodes of every partition and type 0, 1, 2, ...: its own first, by id, then its halo.

    Edges follow their source. Feature vectors and other columns of nodes and edges go along, but not into the numbering, which
    sorts keys alone and has no task that holds a whole partition. Edges with an end that is no node are left out;
    repeated node rows stay, under one local id.
    """
    known = materialize(distinct_nodes(nodes), "nodes")
    own = assign_nodes(known, n, method, seed).select(
        F.col("partition_id").cast("long").alias("partition_id"), "node_type", "node_id", F.lit(False).alias("halo")
    )
    placed = _ruled_edges(edges, n, method, seed)
    sources = known.select(F.col("node_type").alias("src_type"), F.col("node_id").alias("src"))
    between = placed.join(sources, ["src_type", "src"], "left_semi").where("partition_id <> owner_id")
    halo = between.select(
        F.col("partition_id").cast("long").alias("partition_id"),
        F.col("dst_type").alias("node_type"),
        F.col("dst").alias("node_id"),
        F.lit(True).alias("halo"),
    ).distinct()
    halo = halo.join(known, ["node_type", "node_id"], "left_semi").select(*own.columns)
    key = ["partition_id", "node_type"]
    named = materialize(with_row_index(own.unionByName(halo), ["halo", "node_id"], "local_id", group_by=key), "members")
    owner = partition_of("node_type", "node_id", n, method, seed).cast("long").alias("owner_id")
    members = named.select(*key, "local_id", "node_id", owner)

    others = [c for c in nodes.columns if c not in ("node_type", "node_id")]
    mine = named.where("NOT halo").select(*key, "local_id", "node_id")
    local_nodes = nodes.join(mine, ["node_type", "node_id"]).select(*key, "local_id", *others)

    ends = placed.drop("owner_id").withColumn("partition_id", F.col("partition_id").cast("long"))
    for end in ("src", "dst"):
        ids = named.select(
            "partition_id",
            F.col("node_type").alias(f"{end}_type"),
            F.col("node_id").alias(end),
            F.col("local_id").alias(f"__{end}"),
        )
        ends = ends.join(ids, ["partition_id", f"{end}_type", end])
    rest = [c for c in edges.columns if c not in ("src_type", "rel", "dst_type", "src", "dst")]
    local_edges = ends.select(
        "partition_id", "src_type", "rel", "dst_type", F.col("__src").alias("src"), F.col("__dst").alias("dst"), *rest
    )
    return LocalGraph(members, local_nodes, local_edges)


def read_hosts(spark, path: str) -> DataFrame:
    """Host names of a text file in line order; blank lines and ``#`` lines do not count.

    A host file lists machines, so its numbering is a small driver-side list.
    """
    lines = [r["value"].strip() for r in spark.read.text(path).collect()]
    names = [x for x in lines if x and not x.startswith("#")]
    return spark.createDataFrame(list(enumerate(names)), "host_index long, host string")


def placement(sizes: DataFrame, hosts: DataFrame, per_host: int = 1) -> DataFrame:
    """Host of each partition, filled in order; partitions that no host can take say so."""
    held = sizes.withColumn("host_index", F.floor(F.col("partition_id") / per_host).cast("long"))
    return held.join(hosts, "host_index", "left").withColumn("placed", F.col("host").isNotNull()).drop("host_index")


def partition_audit(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Compare the expected rows per partition with those read back from the written table."""
    key = ["partition_id", "kind", "name"]
    both = expected.withColumnRenamed("rows", "expected_rows").join(
        found.withColumnRenamed("rows", "found_rows"), key, "full"
    )
    zero = F.lit(0).cast("long")
    return both.select(
        *key,
        F.coalesce("expected_rows", zero).alias("expected_rows"),
        F.coalesce("found_rows", zero).alias("found_rows"),
    ).withColumn("complete", F.col("expected_rows") == F.col("found_rows"))
