"""What one task holds, and how many bytes an exchange moves per row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hetgraph.operators import propagate as PR
from hetgraph.operators import sampling as S
from hetgraph.operators import structure as ST
from hetgraph.schema import EdgeType
from hetgraph.sinks.store import GraphStore

EDGES = "src_type string, rel string, dst_type string, src long, dst long, edge_weight float"


def edges_of(spark, pairs, rel="click"):
    return spark.createDataFrame([("user", rel, "item", s, d, 1.0) for s, d in pairs], EDGES)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# F1
def test_neighbour_lists_are_collected_over_sorted_rows(spark):
    lists = ST.adjacency_lists(ST.build_adjacency(edges_of(spark, [(i % 3, 900 - i) for i in range(900)])), 128)
    got = {(r.near, r.block): r.neighbors for r in lists.collect()}
    want = {n: sorted(900 - i for i in range(900) if i % 3 == n) for n in range(3)}
    assert got == {(n, b): want[n][128 * b : 128 * b + 128] for n in want for b in range(3)}
    plan = final_plan(lists)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" in plan


# F2
@pytest.mark.parametrize("listed", [3, 65_536])
@pytest.mark.parametrize("hops", [1, 2])
def test_counts_of_neighbourhoods_agree_with_their_links(spark, listed, hops):
    e = edges_of(spark, [(i, j % 7) for i in range(5) for j in range(2 * i)])
    e = e.unionByName(spark.createDataFrame([("item", r, "item", i, (i * i + j) % 9, 1.0) for r in ("a", "b") for i in range(6) for j in range(i + 1)], EDGES))
    seeds = spark.createDataFrame([("user", i) for i in (0, 1, 2, 4, 4, 99)], "seed_type string, seed_id long")
    links = S.khop_edges(seeds, e, hops, None)
    want = links.groupBy("seed_type", "seed_id", "hop", "rel").agg(F.count("*"), F.count_distinct("dst")).collect()
    got = S.khop_counts(seeds, e, hops, listed=listed).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


# F3, F4, F5
@pytest.mark.parametrize("dim", [3, 70])
@pytest.mark.parametrize("how", ["sum", "mean", "max"])
def test_shared_vectors_stay_off_the_edges(spark, how, dim):
    kinds = [[float(k * (i % 5) - i) for i in range(dim)] for k in range(3)]
    nodes = [("user", i, kinds[i % 3]) for i in range(60)] + [("user", 99, None)]
    h = spark.createDataFrame(nodes, "node_type string, node_id long, h array<double>")
    e = edges_of(spark, [(i % 60, i * i % 7) for i in range(400)])
    reducer = "pool" if how == "max" else how
    got = {r.dst: (r.n, r.m) for r in PR.reduce_neighbors(e, h, dim, reducer).collect()}
    for d in range(7):
        near = np.array([kinds[i % 60 % 3] for i in range(400) if i * i % 7 == d])
        if len(near):
            assert got.pop(d) == (len(near), pytest.approx(getattr(near, how)(axis=0).tolist()))
    assert not got
    plan = final_plan(PR.reduce_neighbors(e, h, dim, reducer))
    lines = plan.split("Initial Plan")[0].splitlines()
    last = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and (dim <= 64 or "__p" not in line))
    # No sums of vectors go through an exchange of messages.
    assert "times" in lines[last + 1] and "partial_sum(__s" not in "".join(lines[last:]) and "partial_max" not in "".join(lines[last:])
    with pytest.raises(Exception, match="entries"):
        PR.reduce_neighbors(e.unionByName(edges_of(spark, [(99, 1)])), h, dim, reducer).collect()


# F18, F20
def test_a_chunk_of_a_large_table_is_split(spark, tmp_path):
    def files(rows):
        store = GraphStore(spark, str(tmp_path / f"g{rows}"), 2)
        e = spark.range(rows).selectExpr(*[f"'{v}' AS {c}" for c, v in (("src_type", "user"), ("rel", "click"), ("dst_type", "item"))],
                                         "xxhash64(id) AS src", "xxhash64(id, 1) AS dst", "CAST(1 AS FLOAT) AS edge_weight")
        assert store.write_edges(e, [EdgeType("user", "click", "item")]) == {"user__click__item": rows}
        assert store.read_edges().count() == rows
        return len(store.read_edges().inputFiles())

    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        # Chunks of about 6 MB are split, small ones stay two.
        assert files(500_000) > 4
        assert files(1_000) == 2
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"


# F6, F7
def test_negatives_by_list_and_by_row_are_the_same(spark):
    pairs = [(s, 100 + (s * j) % 37) for s in range(1, 9) for j in range(4 * s)] + [(3, 5), (4, None)]
    e = edges_of(spark, pairs).unionByName(edges_of(spark, [(3, 100 + i) for i in range(40)], "buy"))
    ranges = spark.createDataFrame([("item", 100, 40)], "node_type string, start_id long, num_ids long")
    drawn = [S.exact_negatives(e, ranges, 3, 42, listed).collect() for listed in (0, 9, 256)]
    assert drawn[0] and sorted(map(str, drawn[0])) == sorted(map(str, drawn[1])) == sorted(map(str, drawn[2]))
    links = {(r.rel, r.src, r.dst) for r in e.collect()}
    assert not links & {(r.rel, r.src, r.negative) for r in drawn[2]} and all(100 <= r.negative < 140 for r in drawn[2])
    assert "Window" not in final_plan(S.exact_negatives(e, ranges, 3, 42)) and "Window" in final_plan(S.exact_negatives(e, ranges, 3, 42, 0))
