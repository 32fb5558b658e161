from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import EDGES
from hetgraph.functions.hashing import draw_positions, uniform
from hetgraph.operators import ids as I
from hetgraph.operators import partition as P
from hetgraph.operators import sampling as S
from hetgraph.operators import structure as ST
from hetgraph.sinks.store import GraphStore


def edges_of(spark, pairs, rel="r"):
    return spark.createDataFrame([("n", rel, "n", s, d, 1.0) for s, d in pairs], EDGES)


def seeds_of(spark, ids):
    return spark.createDataFrame([("n", i) for i in ids], "seed_type string, seed_id long")


def test_drawn_subsets_are_even(spark):
    rows = spark.range(6000).select(draw_positions(F.lit(10), 3, 1, F.col("id")).alias("d")).collect()
    assert all(len(set(r.d)) == 3 and min(r.d) >= 0 and max(r.d) < 10 for r in rows)
    hits = Counter(x for r in rows for x in r.d)
    assert all(abs(hits[i] / 6000 - 0.3) < 0.03 for i in range(10))
    pairs = Counter(tuple(sorted(r.d)) for r in rows)
    assert len(pairs) == 120 and max(pairs.values()) < 90


def test_draw_limits(spark):
    one = spark.range(1)
    get = lambda n, k: one.select(draw_positions(F.lit(n), k, 1).alias("d")).first().d
    assert get(0, 3) == [] and get(3, 0) == [] and get(3, 3) == [0, 1, 2] and get(2, 5) == [0, 1]
    assert len(set(get(10**12, 4))) == 4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_masks_partition_the_nodes(graph, seed):
    masks = S.split_masks(graph[0].select("node_type", "node_id"), 0.6, 0.2, seed).collect()
    assert all(r.train_mask + r.val_mask + r.test_mask == 1 for r in masks)
    share = sum(r.train_mask for r in masks) / len(masks)
    assert abs(share - 0.6) < 0.1


def test_edge_sample_draws_copies_apart(spark):
    e = edges_of(spark, [(1, 2)] * 2000)
    n = S.sample_edges(e, 0.25, 7).count()
    assert 400 < n < 600
    keyed = S.sample_edges(e.withColumn("edge_weight", F.lit(1.0)), 0.25, 7, key=["src", "dst"])
    assert keyed.count() in (0, 2000)


def test_fanout_sample_is_a_bounded_subset(spark):
    full = [(0, i) for i in range(3000)] + [(1, 7)] * 4 + [(2, 1), (2, 2)]
    e = edges_of(spark, full)
    got = S.fanout_sample(e, 3, 5).collect()
    per_node = defaultdict(list)
    for r in got:
        per_node[r.src].append(r.dst)
    assert len(per_node[0]) == 3 == len(set(per_node[0]))
    assert per_node[1] == [7, 7, 7]
    assert sorted(per_node[2]) == [1, 2]


def test_samples_do_not_depend_on_the_layout(spark, graph):
    take = lambda e: sorted(map(tuple, S.fanout_sample(e, 4, 9).collect()))
    first = take(graph[1])
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert take(graph[1].repartition(6)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_khop_revisits_and_reuses_the_last_fanout(spark):
    e = edges_of(spark, [(1, 2), (2, 1), (2, 3)])
    got = S.khop_edges(seeds_of(spark, [1]), e, 3, [5]).collect()
    assert sorted((r.hop, r.src, r.dst) for r in got) == [(0, 1, 2), (1, 2, 1), (1, 2, 3), (2, 1, 2)]
    nodes = S.khop_nodes(seeds_of(spark, [1, 99]), S.khop_edges(seeds_of(spark, [1, 99]), e, 1, [5]))
    assert sorted((r.seed_id, r.node_id) for r in nodes.collect()) == [(1, 1), (1, 2), (99, 99)]


def test_khop_matches_brute_force_without_limits(spark, graph):
    edges = graph[1].where("rel <> 'purchase'")
    out = defaultdict(list)
    for r in edges.collect():
        out[(r.src_type, r.src)].append((r.rel, r.dst_type, r.dst))
    seeds = [r.node_id for r in graph[0].where("node_type = 'user'").collect()]
    want = Counter()
    for s in seeds:
        frontier = {("user", s)}
        for hop in range(2):
            nxt = set()
            for node in frontier:
                for rel, t, d in out[node]:
                    want[(s, hop, rel, node[1], d)] += 1
                    nxt.add((t, d))
            frontier = nxt
    frame = spark.createDataFrame([("user", s) for s in seeds], "seed_type string, seed_id long")
    got = S.khop_edges(frame, edges, 2, None).collect()
    assert Counter((r.seed_id, r.hop, r.rel, r.src, r.dst) for r in got) == want


def test_shared_khop_without_limits_is_khop(spark, graph):
    seeds = graph[0].where("node_type = 'user'").select(F.col("node_type").alias("seed_type"), F.col("node_id").alias("seed_id"))
    edges = graph[1].where("rel <> 'purchase'")
    columns = ["seed_type", "seed_id", "hop", "src_type", "rel", "dst_type", "src", "dst"]
    got = S.links_of_seeds(*S.khop_shared(seeds, edges, 2, None)).select(columns).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, S.khop_edges(seeds, edges, 2, None).select(columns).collect()))


@pytest.mark.parametrize("stored", [False, True])
def test_seeds_that_meet_share_a_draw(spark, tmp_path, stored):
    # 300 seeds meet at node 0: its links are fetched once, 2 rows in place of 600.
    e = edges_of(spark, [(i, 0) for i in range(1, 301)] + [(0, 1000 + i) for i in range(4000)])
    if stored:
        store = GraphStore(spark, str(tmp_path / "g"))
        store.write_adjacency(e)
        e = store.read_adjacency()
    links, reached = S.khop_shared(seeds_of(spark, [*range(1, 301), 7, 9999]), e, 2, [1, 2])
    fetched = Counter(r.hop for r in links.collect())
    assert fetched == {0: 300, 1: 2}
    assert Counter(r.hop for r in reached.collect()) == {0: 301, 1: 300}
    own = S.links_of_seeds(links, reached).collect()
    assert Counter(r.hop for r in own) == {0: 300, 1: 600}
    ends = {(r.src, r.dst) for r in own if r.hop == 1}
    assert len(ends) == 2 and {s for s, _ in ends} == {0}
    back, met = S.khop_shared(seeds_of(spark, [0]), edges_of(spark, [(1, 0), (1, 0), (2, 1)]), 2, [5], direction="in")
    assert sorted((r.hop, r.src, r.dst) for r in S.links_of_seeds(back, met, "in").collect()) == [(0, 1, 0), (0, 1, 0), (1, 2, 1)]


def test_many_seeds_on_one_super_node(spark):
    # Every seed reaches node 0, which has 4000 neighbours: the draw fetches 2 per seed.
    e = edges_of(spark, [(i, 0) for i in range(1, 301)] + [(0, 1000 + i) for i in range(4000)])
    got = S.khop_edges(seeds_of(spark, range(1, 301)), e, 2, [1, 2])
    counts = {r.hop: r["count"] for r in got.groupBy("hop").count().collect()}
    assert counts == {0: 300, 1: 600}
    # Draws are made per seed, so they spread.
    assert got.where("hop = 1").select("dst").distinct().count() > 400


def test_blocks_sample_each_node_once_per_layer(spark):
    e = edges_of(spark, [(i, j) for i in range(20) for j in range(3)])
    targets = spark.createDataFrame([("n", 0), ("n", 1), ("n", 0)], "node_type string, node_id long")
    b = S.neighbor_blocks(targets, e, (4, 2), 1).collect()
    per = Counter((r.layer, r.dst) for r in b)
    assert per[(1, 0)] == per[(1, 1)] == 2
    assert all(v <= 4 for k, v in per.items() if k[0] == 0)
    inner = {r.dst for r in b if r.layer == 0}
    assert inner <= {0, 1} | {r.src for r in b if r.layer == 1}


def test_batches_and_splits(spark, graph):
    ids = graph[0].select("node_type", "node_id")
    n = ids.count()
    rows = S.mini_batches(ids, 64, 2, 3).collect()
    for epoch in (0, 1):
        sizes = Counter(r.batch_id for r in rows if r.epoch == epoch)
        assert sorted(sizes) == list(range(-(-n // 64))) and sum(sizes.values()) == n
        assert all(v == 64 for b, v in sizes.items() if b != max(sizes))
    order = lambda e: [(r.node_type, r.node_id) for r in sorted((r for r in rows if r.epoch == e), key=lambda r: (r.batch_id, r.slot))]
    assert order(0) != order(1) and set(order(0)) == set(order(1))
    plain = S.mini_batches(ids, 64, 1, None).orderBy("batch_id", "slot").collect()
    assert [(r.node_type, r.node_id) for r in plain] == sorted(set(order(0)))
    shares = Counter(r.worker for r in S.even_split(ids, 7).collect())
    assert sorted(shares) == list(range(7)) and max(shares.values()) - min(shares.values()) <= 1
    owned = S.owner_split(ids, P.partition_of("node_type", "node_id", 8), 4).collect()
    assert {r.worker for r in owned} == {0, 1, 2, 3}


def test_negatives_are_no_edges(spark, graph):
    ids = I.assign_global_ids(graph[0], ["user", "item"])
    g = I.rewrite_edges(graph[1], ids)
    neg = S.negative_edges(g, I.id_ranges(ids), 3)
    assert neg.join(g, ["rel", "src", "dst"], "left_semi").count() == 0
    span = {r.node_type: (r.start_id, r.end_id) for r in I.id_ranges(ids).collect()}
    assert all(span[r.dst_type][0] <= r.dst <= span[r.dst_type][1] for r in neg.collect())


@pytest.mark.parametrize("method", ["hash", "random", "mod"])
def test_partitions_cover_and_edges_follow(graph, method):
    nodes = {(r.node_type, r.node_id): r.partition_id for r in P.assign_nodes(graph[0], 8, method).collect()}
    assert set(nodes.values()) == set(range(8))
    for r in P.assign_edges(graph[1], 8, method).collect():
        assert r.partition_id == nodes[(r.src_type, r.src)]


def test_partition_ids_stay_positive(spark):
    df = spark.createDataFrame([("n", x) for x in (-(2**63), -1, 0, 2**63 - 1)], "node_type string, node_id long")
    for method in P.METHODS:
        assert all(0 <= r.partition_id < 5 for r in P.assign_nodes(df, 5, method).collect())
    with pytest.raises(ValueError):
        P.partition_of("node_type", "node_id", 5, "metis")


def test_balanced_parts_hold_equal_shares(spark, graph):
    nodes, edges = graph
    parts = P.balanced_map(edges, nodes, 4)
    total = Counter()
    for r in parts.collect():
        total[r.partition_id] += r.weight
    share = sum(total.values()) / 4
    assert set(total) == {0, 1, 2, 3} and all(abs(v - share) < 0.2 * share for v in total.values())


def test_halo_and_cut_agree(graph):
    edges = graph[1]
    placed = P.assign_edges(edges, 4).withColumn("o", P.partition_of("dst_type", "dst", 4))
    want = {(r.partition_id, r.dst_type, r.dst) for r in placed.collect() if r.partition_id != r.o}
    assert {(r.partition_id, r.node_type, r.node_id) for r in P.halo_nodes(edges, 4).collect()} == want
    cut = P.edge_cut(edges, 4).agg(F.sum("cut_edges")).first()[0]
    assert cut == placed.where("partition_id <> o").count()


def test_placement_reports_what_is_left_over(spark, tmp_path):
    path = tmp_path / "hosts.txt"
    path.write_text("# first is master\n\nnode-a\n  node-b  \n#node-x\n")
    hosts = P.read_hosts(spark, str(path))
    sizes = spark.createDataFrame([(i, 10) for i in range(5)], "partition_id int, rows long")
    got = {r.partition_id: (r.host, r.placed) for r in P.placement(sizes, hosts, 2).collect()}
    assert got == {0: ("node-a", True), 1: ("node-a", True), 2: ("node-b", True), 3: ("node-b", True), 4: (None, False)}


def test_uniform_is_in_range(spark):
    r = spark.range(5000).select(uniform(1, F.col("id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= r[0] and r[1] < 1 and abs(r[2] - 0.5) < 0.03
