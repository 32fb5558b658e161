from pyspark.sql import functions as F

from hetgraph.__main__ import parse, run
from hetgraph.runtime import checkpoint_root, drop_intermediates, materialize
from hetgraph.schema import TrainConfig
from hetgraph.plans import jobs
from hetgraph.sources.fixtures import SNAPSHOT, DriverTables
from conftest import SF


def test_export_partition_train(spark, tmp_path):
    """The three commands in a row, from catalog tables to a report."""
    tables = DriverTables(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS graph_cli")
    names = ["nodes_user", "nodes_item", "edges_click", "edges_purchase", "edges_similar"]
    try:
        for n in names:
            tables(n).write.mode("overwrite").partitionBy("dt").option("path", str(tmp_path / n)).saveAsTable(f"graph_cli.{n}")
        out = str(tmp_path / "graph")
        args = ["export", "--dt", SNAPSHOT, "--output", out, "--database", "graph_cli", "--num-partitions", "2", "--with-reverse"]
        assert run(spark, parse(args))["total_nodes"] == 350
        hosts = tmp_path / "hosts"
        hosts.write_text("a\nb\n")
        report = run(spark, parse(["partition", "--graph", out, "--num-partitions", "4", "--hosts", str(hosts)]))
        assert report["audit"].where("not complete").isEmpty()
        assert report["placement"].where("not placed").count() == 2
        trained = run(spark, parse(["train", "--graph", out, "--dim", "64", "--rounds", "1", "--target", "item"]))
        assert trained.best_rounds in (0, 1) and trained.report.count() == 6
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS graph_cli.{n}")
        spark.sql("DROP DATABASE IF EXISTS graph_cli")


def test_best_rounds_follow_the_validation_score(spark, graph):
    # The label is carried by the neighbours only, so own features cannot be best.
    nodes = graph[0]
    edges = graph[1].where("rel = 'similar'")
    from hetgraph.operators.propagate import neighbor_mean, state_of

    mean = neighbor_mean(edges, state_of(nodes), 64)
    label = mean.select(
        F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id"), (F.col("m")[0] > 0.02).cast("int").alias("label")
    )
    labelled = nodes.drop("label").join(label, ["node_type", "node_id"], "left")
    got = jobs.train_best(labelled, edges, 64, TrainConfig(target_node_type="item"), 1, maxIter=30)
    assert got.best_rounds == 1


def test_intermediates_can_be_dropped(spark):
    import os

    materialize(spark.range(3), "t")
    root = f"{checkpoint_root(spark)}/hetgraph/{spark.sparkContext.applicationId}"
    assert os.path.isdir(root)
    drop_intermediates(spark)
    assert not os.path.exists(root)
