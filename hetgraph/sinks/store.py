"""The chunked graph layout on disk.

::

    <root>/manifests/<n>.json                                published states, see ``manifest``
    <root>/node_data/version=<v>/node_type=<t>/              node_id, feat, label
    <root>/edge_data/version=<v>/etype=<s__r__d>/            src_id, dst_id, weight
    <root>/split_data/version=<v>/node_type=<t>/split=<s>/   node_id
    <root>/metadata/version=<v>/                             one line of JSON
    <root>/parts/{nodes,edges}/version=<v>/partition_id=<p>/ partitioned graph
    <root>/adjacency/{in,out}/{links,heads}/version=<v>/     edges by their near end

Every write makes new files. Readers see what the newest manifest names: a write that fails, or an export that fails
between its nodes and its edges, leaves the published state as it was. Types are directories, so a reader
of one type or one partition opens only its files.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hetgraph.operators.partition import partition_sizes
from hetgraph.operators.structure import Adjacency, build_adjacency, slot_of, span_of
from hetgraph.schema import EdgeType, etype_name
from hetgraph.sinks.manifest import Manifests

STORED_NODES = "node_id long, feat array<float>, label int, node_type string"
STORED_EDGES = "src_id long, dst_id long, weight float, etype string"


class GraphStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        num_chunks: int | None = None,
        max_rows: int = 10_000_000,
        state: int | None = None,
    ):
        """``num_chunks`` is the least number of write tasks, a large table gets more; without it Spark chooses by size.

        Reads follow the newest state, or always the one numbered ``state``.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.num_chunks = num_chunks
        self.max_rows = max_rows
        self.state = state
        self.manifests = Manifests(spark, self.root)
        self._stats: dict = {"node_types": {}, "edge_types": {}, "feature_dims": {}}
        self._pending: dict[str, list[dict]] | None = None

    # --- states ---------------------------------------------------------------------------

    @contextmanager
    def snapshot(self, keep: bool = False) -> Iterator[GraphStore]:
        """What is written inside becomes visible together at the end, or not at all.

        The new state has nothing but what is written inside; with ``keep`` it has the parts of the state before, too.
        Raises ``Conflict`` if another writer has published in the meantime.
        """
        if self._pending is not None:
            raise RuntimeError("a snapshot is open already")
        number, tables = self.manifests.latest()
        self._pending = dict(tables) if keep else {}
        try:
            yield self
            self.manifests.publish(number + 1, self._pending)
        finally:
            self._pending = None

    def _together(self):
        """The open snapshot, or one of its own that keeps the rest."""
        return nullcontext() if self._pending is not None else self.snapshot(keep=True)

    def _name(self, table: str, new: list[dict], replaced: Sequence[dict]) -> None:
        """Enter the parts ``new`` of a table, in place of the parts ``replaced``."""
        if self._pending is None:
            with self.snapshot(keep=True):
                self._name(table, new, replaced)
            return
        same = lambda part, other: all(part.get(k) == v for k, v in other.items())
        old = [p for p in self._pending.get(table, []) if not any(same(p, r) for r in replaced)]
        self._pending[table] = old + new

    def pinned(self) -> GraphStore:
        """A store whose reads stay with the state that is the newest one now."""
        return GraphStore(self.spark, self.root, self.num_chunks, self.max_rows, self.manifests.latest()[0])

    def vacuum(self, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Delete versions that the last ``keep`` states do not name, and the other manifests. Returns their folders.

        Younger folders stay, as they may belong to a snapshot that is still open.
        """
        numbers = self.manifests.numbers()
        used = {
            f"{table}/version={part['version']}"
            for n in numbers[-keep:]
            for table, parts in self.manifests.read(n).items()
            for part in parts
        }
        before, gone = (time.time() - 3600 * older_than_hours) * 1000, []
        tables = ["node_data", "edge_data", "split_data", "metadata", "parts/nodes", "parts/edges"]
        tables += [f"adjacency/{d}/{t}" for d in ("in", "out") for t in ("links", "heads")]
        for table in tables:
            for name, changed in self.manifests.list(f"{self.root}/{table}"):
                if f"{table}/{name}" not in used and changed <= before:
                    self.manifests.delete(f"{self.root}/{table}/{name}")
                    gone.append(f"{table}/{name}")
        for n in numbers[:-keep]:
            self.manifests.delete(f"{self.manifests.folder}/{n:010d}.json")
        return gone

    # --- writing --------------------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, parts: Sequence[dict[str, str]], metrics: dict[str, Column], placed: bool = False) -> tuple[list[int], dict]:
        """Replace ``parts`` of a table; rows per part, and what was observed besides.

        With ``num_chunks`` partitions are evened out at run time, whatever type or node dominates, to at least
        that many files; large tables get more files and not larger ones. Counting after
        that exchange keeps a stage that runs again from counting twice. Rows that come out of an exchange by node, which
        is evened out and split at run time, are written as they lie (``placed``): also that stage is the last one.
        """
        version, keys = uuid.uuid4().hex, list(parts[0])
        counts = [
            F.count_if(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in p.items()])).alias(f"__rows{i}")
            for i, p in enumerate(parts)
        ]
        seen = Observation(f"{name}-{version[:8]}")
        if self.num_chunks is not None:
            even = df.hint("rebalance", self.num_chunks)
        else:
            even = df if placed else df.hint("rebalance")
        with self._as_many_tasks():
            (
                even.observe(seen, *counts, *[c.alias(m) for m, c in metrics.items()])
                .write.option("maxRecordsPerFile", self.max_rows)
                .partitionBy(*keys)
                .parquet(f"{self.root}/{name}/version={version}")
            )
        found = seen.get
        rows = [found[f"__rows{i}"] for i in range(len(parts))]
        self._name(name, [{**p, "version": version} for p, n in zip(parts, rows) if n], parts)
        return rows, found

    @contextmanager
    def _as_many_tasks(self) -> Iterator[None]:
        """Inside, ``num_chunks`` partitions of a rebalanced table are split if they are too large, and not merged if they are small."""
        name, before = "spark.sql.adaptive.coalescePartitions.enabled", None
        if self.num_chunks is not None:
            before = self.spark.conf.get(name)
            self.spark.conf.set(name, "false")
        try:
            yield
        finally:
            if before is not None:
                self.spark.conf.set(name, before)

    def _write_whole(self, df: DataFrame, name: str, *keys: str, **settings) -> DataFrame:
        """Replace a table that is not kept by type."""
        version = uuid.uuid4().hex
        df.write.partitionBy(*keys).parquet(f"{self.root}/{name}/version={version}")
        part = {**settings, "schema": df.schema.json(), "version": version}
        self._name(name, [part], [{}])
        return self._open(name, part)

    def write_nodes(
        self,
        nodes: DataFrame,
        node_types: Sequence[str],
        id_col: str = "global_id",
        feature_col: str = "feature_vec",
        label_col: str = "label",
        placed: bool = False,
    ) -> dict[str, int]:
        """Write a long node table; features and label are optional. Returns rows per type.

        Counts and feature lengths are observed while the rows are written. ``placed`` says that the rows come out of a join
        by node and need no further exchange; ``num_chunks`` asks for one all the same.
        """
        columns = [F.col(id_col).alias("node_id")]
        if feature_col in nodes.columns:
            columns.append(F.col(feature_col).alias("feat"))
        if label_col in nodes.columns:
            columns.append(F.col(label_col).alias("label"))
        out = nodes.where(F.col("node_type").isin(list(node_types))).select(*columns, "node_type")
        dims = {}
        if "feat" in out.columns:
            dims = {f"dim{i}": F.max(F.when(F.col("node_type") == t, F.size("feat"))) for i, t in enumerate(node_types)}
        rows, found = self._write(out, "node_data", [{"node_type": t} for t in node_types], dims, placed)
        counts = dict(zip(node_types, rows))
        self._stats["node_types"].update(counts)
        for i, t in enumerate(node_types):
            self._stats["feature_dims"].pop(t, None)
            if found.get(f"dim{i}"):
                self._stats["feature_dims"][t] = found[f"dim{i}"]
        return counts

    def write_edges(
        self,
        edges: DataFrame,
        edge_types: Sequence[EdgeType],
        src_col: str = "src",
        dst_col: str = "dst",
        weight_col: str | None = "edge_weight",
        placed: bool = False,
    ) -> dict[str, int]:
        """Write a long edge table; the weight is optional. Returns rows per edge type. ``placed`` as for nodes."""
        columns = [F.col(src_col).alias("src_id"), F.col(dst_col).alias("dst_id")]
        if weight_col and weight_col in edges.columns:
            columns.append(F.col(weight_col).alias("weight"))
        names = [EdgeType(*e).name for e in edge_types]
        out = edges.select(*columns, etype_name().alias("etype")).where(F.col("etype").isin(names))
        rows, _ = self._write(out, "edge_data", [{"etype": n} for n in names], {}, placed)
        counts = dict(zip(names, rows))
        self._stats["edge_types"].update(counts)
        return counts

    def write_split(self, masks: DataFrame, split: str) -> int:
        """Write the ids whose ``<split>_mask`` is true, away from the node files."""
        rows = mask_index(masks, split).withColumn("split", F.lit(split))
        types = [r["node_type"] for r in masks.select("node_type").distinct().collect()]
        if not types:
            return 0
        return sum(self._write(rows, "split_data", [{"node_type": t, "split": split} for t in types], {})[0])

    def get_stats(self) -> dict:
        nodes, edges = self._stats["node_types"], self._stats["edge_types"]
        return {**self._stats, "total_nodes": sum(nodes.values()), "total_edges": sum(edges.values())}

    def write_metadata(self, metadata: DataFrame) -> None:
        """The description of the graph."""
        version = uuid.uuid4().hex
        metadata.withColumn("written_at", F.current_timestamp()).coalesce(1).write.json(
            f"{self.root}/metadata/version={version}"
        )
        self._name("metadata", [{"version": version}], [{}])

    def write_partitions(self, nodes: DataFrame, edges: DataFrame) -> None:
        """Write nodes and edges that carry ``partition_id``: one job each for all partitions.

        Other columns, such as feature vectors of nodes or edges, go along. The rows of a partition are brought together,
        and a partition too large for one task is split over several files at run time.
        """
        with self._together():
            for name, df, kind in (("nodes", nodes, "node_type"), ("edges", edges, "etype")):
                if kind == "etype" and kind not in df.columns:
                    df = df.withColumn("etype", etype_name()).drop("src_type", "rel", "dst_type")
                self._write_whole(df.hint("rebalance", F.col("partition_id")), f"parts/{name}", "partition_id", kind)

    def write_adjacency(self, edges: DataFrame, direction: str = "out", span_rows: int = 4_000_000) -> None:
        """Store the edges by their near end, for reads of single nodes.

        The links are kept in the order of their dense position, in folders of ``span_rows`` positions; where a node's links
        begin and how many there are stands in a second table, in as many folders by hash of the node.
        """
        links = build_adjacency(edges, direction).links
        with self._together():
            spans = links.withColumn("span", span_of("pos", span_rows))
            stored = self._write_whole(spans, f"adjacency/{direction}/links", "span", span_rows=span_rows)
            slots = (stored.agg(F.max("span")).first()[0] or 0) + 1
            heads = stored.groupBy("near", "near_type", "rel", "far_type").agg(
                F.min("pos").alias("start"), F.count(F.lit(1)).alias("degree")
            )
            heads = heads.withColumn("slot", slot_of("near_type", "near", slots))
            self._write_whole(
                heads.hint("rebalance", F.col("slot")), f"adjacency/{direction}/heads", "slot", slots=slots
            )

    # --- reading --------------------------------------------------------------------------

    def tables(self) -> dict[str, list[dict]]:
        """The state that is read: for each table its parts and their versions."""
        return self.manifests.latest()[1] if self.state is None else self.manifests.read(self.state) if self.state else {}

    def _read(self, name: str, schema: str) -> DataFrame:
        parts = self.tables().get(name, [])
        if not parts:
            # Not written: an empty table of that shape.
            return self.spark.createDataFrame([], schema)
        folders = sorted({f"{self.root}/{name}/version={p['version']}" for p in parts})
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders)
        # A version may hold parts that later ones have replaced. Only partition columns are asked for.
        named = [reduce(lambda a, b: a & b, [F.col(k) == v for k, v in p.items()]) for p in parts]
        return rows.where(reduce(or_, named))

    def _read_whole(self, name: str) -> tuple[DataFrame, dict]:
        parts = self.tables().get(name)
        if not parts:
            raise FileNotFoundError(f"{self.root} has no {name}")
        return self._open(name, parts[0]), parts[0]

    def _open(self, name: str, part: dict) -> DataFrame:
        schema = StructType.fromJson(json.loads(part["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/version={part['version']}")

    def read_nodes(self) -> DataFrame:
        """``node_type, node_id, feature_vec, label``; columns that were not written are null."""
        rows = self._read("node_data", STORED_NODES)
        return rows.select("node_type", "node_id", F.col("feat").alias("feature_vec"), "label")

    def read_edges(self) -> DataFrame:
        """``src_type, rel, dst_type, src, dst, edge_weight``."""
        parts = F.split("etype", "__")
        return self._read("edge_data", STORED_EDGES).select(
            parts[0].alias("src_type"),
            parts[1].alias("rel"),
            parts[2].alias("dst_type"),
            F.col("src_id").alias("src"),
            F.col("dst_id").alias("dst"),
            F.col("weight").alias("edge_weight"),
        )

    def read_split(self, split: str) -> DataFrame:
        rows = self._read("split_data", "node_id long, node_type string, split string")
        return rows.where(F.col("split") == split).select("node_type", "node_id")

    def read_partition(self, partition_id: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Nodes and edges of one partition, or of all; only its directories are opened."""
        store = self if self.state is not None else self.pinned()
        out = []
        for name in ("nodes", "edges"):
            df = store._read_whole(f"parts/{name}")[0]
            if name == "edges":
                parts = F.split("etype", "__")
                df = df.withColumns(
                    {"src_type": parts[0], "rel": parts[1], "dst_type": parts[2]}
                ).drop("etype")
            out.append(df if partition_id is None else df.where(F.col("partition_id") == partition_id))
        return out[0], out[1]

    def partition_sizes(self) -> DataFrame:
        """Rows per partition as found in the written files."""
        return partition_sizes(*self.read_partition())

    def read_adjacency(self, direction: str = "out") -> Adjacency:
        """What ``write_adjacency`` stored. Reads of few nodes open only the folders that hold their rows."""
        store = self if self.state is not None else self.pinned()
        links, kept = store._read_whole(f"adjacency/{direction}/links")
        heads, spread = store._read_whole(f"adjacency/{direction}/heads")
        return Adjacency(links, heads, kept["span_rows"], spread["slots"])

    def read_metadata(self) -> DataFrame:
        """The description; no row before there is one."""
        schema = f"{METADATA_SCHEMA}, written_at timestamp"
        parts = self.tables().get("metadata")
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.root}/metadata/version={parts[0]['version']}")


METADATA_SCHEMA = (
    "graph_name string, node_types array<struct<node_type:string,num_nodes:bigint,start_id:bigint,"
    "end_id:bigint,feature_dim:int>>, edge_types array<struct<src_type:string,rel:string,"
    "dst_type:string,etype:string,num_edges:bigint>>, total_nodes bigint, total_edges bigint, "
    "num_partitions int, num_classes int"
)


def mask_index(masks: DataFrame, split: str) -> DataFrame:
    return masks.where(F.col(f"{split}_mask")).select("node_type", "node_id")


def feature_dims(nodes: DataFrame, vec: str = "feature_vec") -> DataFrame:
    """Vector length and number of labels per type; a type without vectors has none."""
    return nodes.groupBy("node_type").agg(
        F.max(F.size(vec)).alias("feature_dim"), F.count_distinct("label").alias("num_classes")
    )


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows per node type and edge type, with the totals under the name null."""
    n = nodes.groupBy(F.lit("node").alias("kind"), F.col("node_type").alias("name"))
    e = edges.groupBy(F.lit("edge").alias("kind"), etype_name().alias("name"))
    parts = n.agg(F.count(F.lit(1)).alias("rows")).unionByName(e.agg(F.count(F.lit(1)).alias("rows")))
    # The rollup adds one total per kind to a handful of rows.
    return (
        parts.rollup("kind", "name").agg(F.sum("rows").alias("rows")).where("kind IS NOT NULL")
    )


def describe_graph(
    node_sizes: DataFrame,
    edge_sizes: DataFrame,
    num_partitions: int,
    graph_name: str = "hetero_graph",
    num_classes: int | None = None,
) -> DataFrame:
    """One-row description from one row per node type and one per edge type.

    ``node_sizes``: ``node_type, num_nodes, start_id, end_id, feature_dim``;
    ``edge_sizes``: ``src_type, rel, dst_type, num_edges``.
    """
    n = node_sizes.groupBy().agg(
        F.sort_array(
            F.collect_list(F.struct("node_type", "num_nodes", "start_id", "end_id", "feature_dim"))
        ).alias("node_types"),
        F.sum("num_nodes").alias("total_nodes"),
    )
    e = edge_sizes.groupBy().agg(
        F.sort_array(
            F.collect_list(
                F.struct("src_type", "rel", "dst_type", etype_name().alias("etype"), "num_edges")
            )
        ).alias("edge_types"),
        F.sum("num_edges").alias("total_edges"),
    )
    edge_side = e.select(F.struct("*")).scalar()
    return n.select(
        F.lit(graph_name).alias("graph_name"),
        "node_types",
        edge_side["edge_types"].alias("edge_types"),
        "total_nodes",
        edge_side["total_edges"].alias("total_edges"),
        F.lit(num_partitions).alias("num_partitions"),
        F.lit(num_classes).cast("int").alias("num_classes"),
    )
