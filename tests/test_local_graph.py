"""Partitions that name their nodes by themselves."""

from pyspark.sql import functions as F

from hetgraph.operators import partition as P


def test_local_graph_is_the_graph(spark, small):
    nodes, edges, *_ = small
    odd = spark.createDataFrame([("user", "click", "item", 0, 99, 1.0), ("user", "click", "item", 99, 0, 1.0)], edges.schema)
    table = edges.unionByName(odd).withColumn("vec", F.array("edge_weight", F.lit(2.0)))
    local = P.local_graph(nodes.unionByName(nodes.limit(1)), table, 3, "mod")
    members = local.members.collect()
    seen = {}
    for m in members:
        seen.setdefault((m.partition_id, m.node_type), []).append(m)
    for rows in seen.values():
        rows.sort(key=lambda m: m.local_id)
        assert [m.local_id for m in rows] == list(range(len(rows)))
        # Own nodes come first, each part in the order of the ids.
        order = [(m.owner_id != m.partition_id, m.node_id) for m in rows]
        assert order == sorted(order) and all(m.owner_id == m.node_id % 3 for m in rows)
    assert sum(m.owner_id == m.partition_id for m in members) == 10
    back = {(m.partition_id, m.node_type, m.local_id): m.node_id for m in members}
    got = sorted((e.rel, back[e.partition_id, e.src_type, e.src], back[e.partition_id, e.dst_type, e.dst]) for e in local.edges.collect())
    assert got == sorted((e.rel, e.src, e.dst) for e in edges.collect())
    assert {tuple(e.vec) for e in local.edges.collect()} == {(1.0, 2.0)}
    assert local.nodes.count() == 11 and set(local.nodes.columns) == {"partition_id", "node_type", "local_id", "feature_vec", "label"}
    none = P.local_graph(nodes.limit(0), table, 3, "mod")
    assert none.members.collect() == [] and none.edges.collect() == []
