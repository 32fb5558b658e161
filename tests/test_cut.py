"""Partitions that look at the cut."""

from conftest import EDGES, NODES
from pyspark.sql import functions as F

from hetgraph.operators import cut as C
from hetgraph.operators import partition as P


def _cut(edges, owner):
    return P.edge_cut(edges, owner=owner.drop("weight")).agg(F.sum("cut_edges")).first()[0]


def _loads(owner):
    return {r[0]: r[1] for r in owner.groupBy("partition_id").agg(F.sum("weight")).collect()}


def test_groups_across_the_id_range(spark):
    """Four groups by id modulo four, which a cut of the id range tears apart, and a node that all link to."""
    nodes = spark.createDataFrame([("user", i, None, 0) for i in range(160)], NODES)
    inner = [(i, (i + 4 * k) % 160) for i in range(160) for k in (1, 2, 3, 7, 11)]
    outer = [(i, (i * 37 + 1) % 160) for i in range(0, 160, 4)] + [(i, 0) for i in range(0, 160, 2)]
    edges = spark.createDataFrame([("user", "knows", "user", a, b, 1.0) for a, b in inner + outer], EDGES)
    before = P.balanced_map(edges, nodes, 4)
    after = C.cut_aware_map(edges, nodes, 4, rounds=8, slack=0.1)
    assert after.count() == 160 and after.select("node_id").distinct().count() == 160
    loads = _loads(after)
    assert max(loads.values()) <= max(-(-sum(loads.values()) * 11 // 40), *_loads(before).values())
    assert sum(loads.values()) == sum(_loads(before).values())
    assert _cut(edges, after) < _cut(edges, before)
    again = C.cut_aware_map(edges.repartition(3), nodes.repartition(5), 4, rounds=8, slack=0.1)
    assert after.exceptAll(again).isEmpty()


def test_odd_tables(spark, small):
    nodes, edges, *_ = small
    none = C.cut_aware_map(edges.limit(0), nodes, 3, rounds=2)
    assert none.count() == 10
    assert C.cut_aware_map(edges, nodes.limit(0), 3, rounds=2).collect() == []
    # Self loops, parallel edges, ends that are no node, repeated node rows.
    odd = spark.createDataFrame([("user", "click", "item", 99, 0, 1.0), ("user", "click", "item", None, 0, 1.0)], EDGES)
    got = C.cut_aware_map(edges.unionByName(odd), nodes.unionByName(nodes), 2, rounds=3)
    assert got.count() == 10 and {r.partition_id for r in got.collect()} <= {0, 1}


def test_only_neighbours_of_moved_nodes_are_told(spark, monkeypatch):
    """After the first sums a round reads the lists of the nodes that move, and comes to the sums of a full count."""
    nodes = spark.createDataFrame([("user", i, None, 0) for i in range(160)], NODES)
    pairs = [(i, (i + 4 * k) % 160) for i in range(160) for k in (1, 2, 3)] + [(i, 0) for i in range(160)] * 2
    edges = spark.createDataFrame([("user", "knows", "user", a, b, 1.0) for a, b in [*pairs, (5, 999), (999, 5)]], EDGES)
    monkeypatch.setattr(C, "LISTED", 50)  # node 0 has several lists
    told, kept, real, tally = [], [], C._told, C._tally
    monkeypatch.setattr(C, "_told", lambda lists, changes: told.append((lists, changes.count())) or real(lists, changes))
    monkeypatch.setattr(C, "_tally", lambda sums, owner: kept.append((sums, owner)) or tally(sums, owner))
    monkeypatch.setattr(C, "drop_tables", lambda *a: None)
    C.cut_aware_map(edges, nodes, 4, rounds=3, slack=0.1)
    assert told[0][1] == 160 and len(told) > 1 and all(n < 160 for _, n in told[1:])
    sizes = told[0][0].where("node_id = 0").selectExpr("size(fars)").collect()
    assert len(sizes) > 1 and max(r[0] for r in sizes) < 100
    for sums, owner in kept:
        far = owner.select(F.col("node_id").alias("b"), F.col("partition_id").alias("to"))
        ends = edges.selectExpr("src a", "dst b").unionAll(edges.selectExpr("dst a", "src b")).where("a <> b AND a <> 999")
        full = ends.join(far, "b").groupBy(F.col("a").alias("node_id"), "to").agg(F.count("*").alias("links"))
        assert sorted(full.collect()) == sorted(sums.where("node_id <> 999").select("node_id", "to", "links").collect())


def test_cut_totals(spark, small):
    nodes, edges, *_ = small
    maps = {str(n): P.balanced_map(edges, nodes, n) for n in (2, 3)}
    assert list(P.cut_totals(edges, maps).first()) == [_cut(edges, m) for m in maps.values()]
