from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import EDGES, NODES
from hetgraph import runtime
from hetgraph.operators import ids as I
from hetgraph.operators import structure as ST


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_row_index_equals_a_global_sort(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    got = pairs(I.with_row_index(df, ["k"], "i"), "k", "i")
    assert [i for _, i in got] == list(range(1000))


def test_row_index_restarts_per_group_and_ignores_layout(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 501).alias("k"))
    first = pairs(I.with_row_index(df, ["k"], "i", ["g"]), "g", "k", "i")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        second = pairs(I.with_row_index(df.repartition(5), ["k"], "i", ["g"]), "g", "k", "i")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert first == second
    for g in range(3):
        assert [i for x, _, i in first if x == g] == list(range(len([1 for x in first if x[0] == g])))


def test_row_index_never_sorts_in_one_task(spark, monkeypatch):
    seen = []
    real = I.materialize
    monkeypatch.setattr(I, "materialize", lambda df, label: seen.append(df) or real(df, label))
    I.with_row_index(spark.range(100).select((F.col("id") * 37 % 101).alias("k")), ["k"], "i")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


def test_copies_are_numbered_across_pieces(spark):
    rows = [("a", 1)] * 25 + [("b", 2)] * 10 + [("c", 3)]
    got = I.number_copies(spark.createDataFrame(rows, "k string, v int"), ["k", "v"], chunk=10)
    assert pairs(got, "k", "copy") == [("a", i) for i in range(1, 26)] + [("b", i) for i in range(1, 11)] + [("c", 1)]


def test_global_ids_cover_types_in_order(spark):
    nodes = spark.createDataFrame(
        [("item", 5), ("item", 1), ("user", 5), ("user", 5), ("user", None), ("other", 1)], "node_type string, node_id long"
    )
    got = pairs(I.assign_global_ids(nodes, ["user", "item"]), "node_type", "node_id", "global_id")
    # Duplicates share an id, nulls and unlisted types get none, equal ids of two types differ.
    assert got == [("item", 1, 1), ("item", 5, 2), ("user", 5, 0)]


def test_ids_beyond_double_precision_stay_apart(spark):
    big = 2**60
    df = spark.createDataFrame([("user", big + i) for i in range(50)], "node_type string, node_id long")
    got = pairs(I.assign_global_ids(df, ["user"]), "node_id", "global_id")
    assert got == [(big + i, i) for i in range(50)]


def test_rewrite_drops_and_reports_unknown_ends(spark):
    nodes = spark.createDataFrame([("user", 1), ("item", 1)], "node_type string, node_id long")
    edges = spark.createDataFrame(
        [("user", "buys", "item", s, d, 1.0) for s, d in [(1, 1), (1, 1), (2, 1), (1, 9), (None, 9)]], EDGES
    )
    ids = I.assign_global_ids(nodes, ["user", "item"])
    assert pairs(I.rewrite_edges(edges, ids), "src", "dst") == [(0, 1), (0, 1)]
    assert I.dangling_edges(edges, ids).first()[3:] == (2, 2, 3, 5)


def test_export_keeps_duplicate_rows_and_empty_types(spark):
    nodes = spark.createDataFrame([("user", 1, None, None), ("user", 1, None, 3)], NODES)
    ids = I.assign_global_ids(nodes, ["user", "item"])
    assert I.attach_global_id(nodes, ids).count() == 2
    assert pairs(I.id_ranges(ids), "node_type", "start_id", "end_id", "num_ids") == [("user", 0, 0, 1)]


def test_relabel(spark):
    rows = [(1, "user", 9), (1, "item", 4), (1, "item", 2), (2, "item", 4), (2, "item", 4)]
    got = I.relabel_subgraph(spark.createDataFrame(rows, "seed int, node_type string, node_id long"), ["seed"])
    assert pairs(got, "seed", "node_type", "node_id", "local_id") == [
        (1, "item", 2, 0), (1, "item", 4, 1), (1, "user", 9, 0), (2, "item", 4, 0),
    ]


def test_degrees(spark):
    e = spark.createDataFrame(
        [("n", "r", "n", s, d, 1.0) for s, d in [(1, 2), (1, 2), (3, 3), (4, 1)]], EDGES
    )
    assert pairs(ST.degrees(e, "out"), "node_id", "degree") == [(1, 2), (3, 1), (4, 1)]
    assert pairs(ST.degrees(e, "in"), "node_id", "degree") == [(1, 1), (2, 2), (3, 1)]
    both = pairs(ST.degrees(e, "anything"), "node_id", "out_degree", "in_degree", "degree")
    assert both == [(1, 2, 1, 3), (2, 0, 2, 2), (3, 1, 1, 2), (4, 1, 0, 1)]
    assert sum(r[3] for r in both) == 2 * e.count()
    assert pairs(ST.super_nodes(e, 2), "node_id") == [(1,)]


def test_reverse_twice_is_the_same_graph(spark, small):
    e = small[1]
    back = ST.reverse_edges(ST.reverse_edges(e))
    assert pairs(back, "src_type", "src", "dst_type", "dst") == pairs(e, "src_type", "src", "dst_type", "dst")
    assert {r[0] for r in back.select("rel").collect()} == {"rev_rev_click", "rev_rev_similar", "rev_rev_sold_to"}
    assert ST.with_reverse(e).count() == 2 * e.count()


def test_adjacency_blocks_hold_every_neighbour_once(spark):
    hot = [("n", "r", "n", 0, i % 40, 1.0) for i in range(100)] + [("n", "r", "n", 1, 5, 1.0)]
    adj = ST.build_adjacency(spark.createDataFrame(hot, EDGES))
    assert pairs(adj.links, "pos") == [(i,) for i in range(101)]
    rows = ST.adjacency_lists(adj, width=16).collect()
    assert max(len(r.neighbors) for r in rows) == 16
    assert Counter(x for r in rows if r.near == 0 for x in r.neighbors) == Counter(i % 40 for i in range(100))


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    class Context:
        master, applicationId = "yarn", "x"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        runtime.checkpoint_root(Session())


def test_running_total(spark):
    rows = [(i * 17 % 101, i % 5 + 1) for i in range(101)]
    got, total = I.with_running_total(spark.createDataFrame(rows, "k long, w long").repartition(6), ["k"], "w", "before")
    want, acc = [], 0
    for k, w in sorted(rows):
        want.append((k, acc))
        acc += w
    assert pairs(got, "k", "before") == want and total == acc


def test_relabelled_edges(spark):
    labels = spark.createDataFrame(
        [(1, "n", 7, 0), (1, "n", 9, 1), (2, "n", 7, 0)], "seed int, node_type string, node_id long, local_id long"
    )
    e = spark.createDataFrame([(1, "n", "r", "n", 9, 7)], "seed int, src_type string, rel string, dst_type string, src long, dst long")
    got = pairs(I.relabel_edges(e, labels, ["seed"]), "seed", "rel", "src", "dst")
    assert got == [(1, "r", 1, 0), (2, "self", 0, 0)]


def test_a_hot_source_is_split(spark):
    """A third of all edges leave one node: the join with its features is split at run time."""
    from hetgraph.operators.propagate import neighbor_mean

    n = 60_000
    # More than one map task, since a split follows the map outputs.
    edges = spark.range(n, numPartitions=8).select(
        F.lit("u").alias("src_type"), F.lit("r").alias("rel"), F.lit("i").alias("dst_type"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("src"), (F.col("id") % 50).alias("dst"),
    )
    h = spark.range(n).select(F.lit("u").alias("node_type"), F.col("id").alias("node_id"), F.array(F.col("id") * 1.0).alias("h"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = neighbor_mean(edges, h, 1)
        got = {r.dst: r.m[0] for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    want = {}
    for i in range(n):
        want.setdefault(i % 50, []).append(0 if i % 3 == 0 else i)
    assert all(abs(got[d] - sum(v) / len(v)) < 1e-6 for d, v in want.items())


def test_adjacency_sorts_a_written_table(spark, monkeypatch):
    """The pass for the bounds of the sort reads files alone, and equal edges still spread over its partitions."""
    seen, real = [], ST.with_row_index
    monkeypatch.setattr(ST, "with_row_index", lambda df, *a: seen.append(df) or real(df, *a))
    copies = spark.range(40_000).selectExpr(
        "'u' src_type", "'r' rel", "'i' dst_type", "if(id < 30000, 7, id % 5) src", "if(id < 30000, 3, id % 9) dst"
    )
    edges = copies.repartition(6, "dst").groupBy(*copies.columns).count().selectExpr(
        "src_type", "rel", "dst_type", "src", "dst", "explode(sequence(1, count)) k"
    ).drop("k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        built = ST.build_adjacency(edges)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    links = built.links.orderBy("pos").collect()
    assert [r.pos for r in links] == list(range(40_000))
    order = [(r.near, r.far) for r in links]
    assert order == sorted(order) and order.count((7, 3)) == 30_000
    held = built.links.where("near = 7").select(F.input_file_name()).distinct().count()
    assert held > 1
    heads = {(r.near, r.start, r.degree) for r in built.heads.collect()}
    assert heads == {(n, min(i for i, o in enumerate(order) if o[0] == n), sum(o[0] == n for o in order)) for n in (0, 1, 2, 3, 4, 7)}
