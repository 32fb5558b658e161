"""Published states of a store, and reads of single nodes from a stored adjacency."""

import pytest
from pyspark.sql import functions as F

from hetgraph.operators import sampling as S
from hetgraph.operators import structure as ST
from hetgraph.operators.structure import build_adjacency
from hetgraph.plans import jobs
from hetgraph.schema import EdgeType, GraphConfig
from hetgraph.sinks.manifest import Conflict
from hetgraph.sinks.store import GraphStore
from hetgraph.sources.fixtures import CONFIG, SNAPSHOT, DriverTables
from conftest import NODES, SF

E = [EdgeType("user", "click", "item")]


def graph_of(spark, n):
    nodes = spark.createDataFrame([("user", i, [float(n)], n) for i in range(n)] + [("item", i, [1.0], n) for i in range(n)], NODES)
    edges = spark.range(n).select(
        F.lit("user").alias("src_type"), F.lit("click").alias("rel"), F.lit("item").alias("dst_type"),
        F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1.0).cast("float").alias("edge_weight"),
    )
    return nodes, edges


def sizes(store):
    return store.read_nodes().count(), store.read_edges().count()


def test_a_failing_export_leaves_the_old_state(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), 2)
    nodes, edges = graph_of(spark, 5)
    with store.snapshot():
        store.write_nodes(nodes, ["user", "item"], id_col="node_id")
        store.write_edges(edges, E)
        assert sizes(store) == (0, 0)  # nothing shows before the end
    assert sizes(store) == (10, 5)
    reader = store.pinned()
    nodes, edges = graph_of(spark, 7)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        with store.snapshot():
            store.write_nodes(nodes, ["user", "item"], id_col="node_id")
            store.write_edges(edges.withColumn("dst", F.col("dst") / (F.col("dst") - 6)).withColumn("dst", F.col("dst").cast("long")), E)
    assert sizes(store) == (10, 5)
    with store.snapshot():
        store.write_nodes(nodes, ["user"], id_col="node_id")
        store.write_edges(edges, E)
    # The type that the export does not name is gone, and a pinned reader is where it was.
    assert sizes(store) == (7, 7) and {r.node_type for r in store.read_nodes().collect()} == {"user"}
    assert sizes(reader) == (10, 5)


def test_job_that_dies_between_nodes_and_edges(spark, tmp_path, monkeypatch):
    config = GraphConfig(output_path=str(tmp_path / "out"), num_partitions=2)
    jobs.export_graph(spark, DriverTables(spark, SF), config, SNAPSHOT)
    before = sizes(GraphStore(spark, config.output_path))

    def die(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(GraphStore, "write_edges", die)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.export_graph(spark, DriverTables(spark, SF), GraphConfig(output_path=config.output_path, node_types=("user",)), SNAPSHOT)
    after = GraphStore(spark, config.output_path)
    assert sizes(after) == before and after.read_metadata().first().total_nodes == before[0]


def test_two_writers_and_vacuum(spark, tmp_path):
    store, other = (GraphStore(spark, str(tmp_path / "g"), 1) for _ in range(2))
    nodes, _ = graph_of(spark, 3)
    with pytest.raises(Conflict):
        with store.snapshot():
            store.write_nodes(nodes, ["user"], id_col="node_id")
            other.write_nodes(nodes, ["item"], id_col="node_id")
    assert {r.node_type for r in store.read_nodes().collect()} == {"item"}
    store.write_nodes(nodes, ["user"], id_col="node_id")
    assert store.vacuum() == []  # everything is too young
    gone = store.vacuum(keep=1, older_than_hours=0)
    assert len(gone) == 1 and gone[0].startswith("node_data/")  # what the writer that came too late had written
    assert store.manifests.numbers() == [2] and store.read_nodes().count() == 6


def test_empty_tables(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    nodes, edges = graph_of(spark, 3)
    none = edges.limit(0)
    assert store.write_edges(none, E) == {"user__click__item": 0} and store.read_edges().count() == 0
    store.write_adjacency(none)
    seeds = nodes.select(F.col("node_type").alias("seed_type"), F.col("node_id").alias("seed_id"))
    assert S.khop_edges(seeds, store.read_adjacency()).count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_adjacency("in")


# --- adjacency ----------------------------------------------------------------------------


def scans(df):
    """``files read, files there`` of every scan of the executed plan."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec":
            out.append((node.metrics().apply("numFiles").value(), node.relation().location().inputFiles().__len__()))
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_ten_seeds_open_few_files(spark, graph, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    store.write_adjacency(graph[1], span_rows=200)
    adjacency = store.read_adjacency()
    path = str(tmp_path / "seeds")
    spark.range(1, 11).select(F.lit("user").alias("node_type"), F.col("id").alias("node_id")).write.parquet(path)
    seeds = spark.read.parquet(path)
    for fanout in (2, None):
        drawn = S.draw_links(seeds, adjacency, fanout, 1, [])
        assert drawn.count()
        # The heads are read by a job of their own, whose plan is looked at below.
        large = [s for s in scans(drawn) if s[1] > 20]
        assert len(large) == 1 and large[0][0] <= 30 <= large[0][1], large
    asked = seeds.withColumn("slot", ST.slot_of("node_type", "node_id", adjacency.slots)).where("slot >= 0")
    heads = adjacency.heads.withColumnsRenamed({"near_type": "node_type", "near": "node_id"})
    large = [s for s in scans(asked.join(heads, ["slot", "node_type", "node_id"])) if s[1] > 20]
    assert len(large) == 1 and large[0][0] <= 10, large


def test_stored_and_built_agree(spark, graph, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    seeds = spark.range(1, 40).select(F.lit("user").alias("seed_type"), F.col("id").alias("seed_id"))
    for direction in ("out", "in"):
        store.write_adjacency(graph[1], direction, span_rows=1000)
        for limits in ((3, 2), None):
            found = [
                sorted(map(tuple, S.khop_edges(seeds, e, 2, limits, 7, direction).collect()))
                for e in (graph[1], build_adjacency(graph[1], direction), store.read_adjacency(direction))
            ]
            assert found[0] == found[1] == found[2]
            assert bool(found[0]) == (direction == "out")
