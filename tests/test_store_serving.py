import dataclasses
import json
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from hetgraph.functions.weights import formula_linear
from hetgraph.operators import features as FE
from hetgraph.operators import layers as L
from hetgraph.operators import partition as P
from hetgraph.operators import sampling as S
from hetgraph.operators import serving as SV
from hetgraph.plans import jobs
from hetgraph.schema import EdgeType, GraphConfig, TrainConfig, conform, NODE_SCHEMA, parse_etype
from hetgraph.sinks.store import GraphStore
from hetgraph.sources import layout
from hetgraph.sources.fixtures import CONFIG, SNAPSHOT, DriverTables
from hetgraph.sources.tables import scan_edges, scan_nodes
from hetgraph.streaming import feature_log
from conftest import SF

TYPES = ["user", "item"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- schema and scans ---------------------------------------------------------------------


def test_conform(spark):
    df = spark.createDataFrame([("7", "2024-01-01", 1)], "node_id string, dt string, extra int")
    with pytest.raises(ValueError):
        conform(df, NODE_SCHEMA)
    ok = conform(df, NODE_SCHEMA, optional=("feature_vec", "label"))
    assert ok.columns == ["node_id", "dt"] and ok.first().node_id == 7
    with pytest.raises(ValueError):
        GraphConfig(num_partitions=0)


def test_scans_select_snapshot_and_ends(spark):
    nodes = spark.createDataFrame(
        [(1, [1.0], 0, "d1"), (2, [2.0], 1, "d2")], "node_id long, feature_vec array<float>, label int, dt string"
    )
    assert [r.node_id for r in scan_nodes(nodes, "user", "d2").collect()] == [2]
    edges = spark.createDataFrame(
        [(1, 2, "user", "item", "d1"), (1, 2, "user", "shop", "d1"), (3, 2, "user", "item", "d2")],
        "src_node_id long, dst_node_id long, src_type string, dst_type string, dt string",
    )
    got = scan_edges(edges, EdgeType("user", "buys", "item"), "d1")
    assert got.columns == ["src_type", "rel", "dst_type", "src", "dst"] and got.count() == 1


def test_etype_names(spark):
    assert EdgeType("a", "r", "b").name == "a__r__b" and EdgeType("a", "r", "b").reverse() == ("b", "rev_r", "a")
    got = spark.createDataFrame([("a__r__b",), ("a_r_b",), ("a__r__b__c",)], "e string").select(parse_etype("e").alias("p"))
    assert [r.p for r in got.collect()] == [("a", "r", "b"), None, None]


# --- store --------------------------------------------------------------------------------


def test_store_replaces_one_type_and_keeps_the_rest(spark, tmp_path, small):
    nodes, edges, *_ = small
    etypes = [EdgeType(*r) for r in edges.select("src_type", "rel", "dst_type").distinct().collect()]
    store = GraphStore(spark, str(tmp_path / "g"), 2)
    assert store.read_nodes().count() == 0
    assert store.write_nodes(nodes, TYPES, id_col="node_id") == {"user": 4, "item": 6}
    assert store.write_edges(edges, etypes)["user__click__item"] == 5
    assert store.get_stats()["feature_dims"] == {"user": 5, "item": 7}
    assert store.get_stats()["total_nodes"] == 10 and store.get_stats()["total_edges"] == edges.count()
    store.write_nodes(nodes.where("node_type = 'user' and node_id < 2").drop("label"), ["user"], id_col="node_id")
    back = {r.node_type: r["count"] for r in store.read_nodes().groupBy("node_type").count().collect()}
    assert back == {"user": 2, "item": 6}
    assert store.read_nodes().where("node_type = 'user' and label is not null").count() == 0
    cols = ["src_type", "rel", "dst_type", "src", "dst", "edge_weight"]
    assert rows(store.read_edges().select(cols)) == rows(edges.select(cols))
    for split in ("train", "val", "test"):
        store.write_split(S.split_masks(nodes, 0.5, 0.2), split)
    assert sum(store.read_split(s).count() for s in ("train", "val", "test")) == 10
    # The index files are no node files.
    assert store.read_nodes().count() == 8


def test_partition_read_opens_one_directory(spark, tmp_path, small):
    nodes, edges, *_ = small
    store = GraphStore(spark, str(tmp_path / "g"), 2)
    store.write_nodes(nodes, TYPES, id_col="node_id")
    store.write_edges(edges, [EdgeType(*r) for r in edges.select("src_type", "rel", "dst_type").distinct().collect()])
    hosts = spark.createDataFrame([(0, "a"), (1, "b")], "host_index long, host string")
    for method in ("mod", "balanced"):
        report = jobs.partition_graph(store, 3, method, hosts)
        assert all(r.complete for r in report["audit"].collect())
        assert {r.placed for r in report["placement"].where("partition_id < 2").collect()} == {True}
    n, e = store.read_partition(1)
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_id" in plan
    assert store.read_partition()[1].count() == edges.count()


def test_audit_finds_a_missing_file(spark):
    want = spark.createDataFrame([(0, "node", "user", 5), (1, "node", "user", 4)], "partition_id int, kind string, name string, rows long")
    found = want.where("partition_id = 0")
    assert [(r.partition_id, r.complete) for r in P.partition_audit(want, found).orderBy("partition_id").collect()] == [(0, True), (1, False)]


def test_export_job_and_reverse_edges(spark, tmp_path):
    config = GraphConfig(output_path=str(tmp_path / "out"), num_partitions=2, with_reverse=True)
    stats = jobs.export_graph(spark, DriverTables(spark, SF), config, SNAPSHOT)
    again = jobs.export_graph(spark, DriverTables(spark, SF), config, SNAPSHOT)
    assert stats == again and stats["total_nodes"] == 350
    assert stats["edge_types"]["item__rev_purchase__user"] == stats["edge_types"]["user__purchase__item"] == 6000
    meta = GraphStore(spark, config.output_path).read_metadata().first()
    assert meta.total_nodes == 350 and len(meta.edge_types) == 6 and meta.num_partitions == 2
    assert {n.node_type: (n.start_id, n.end_id, n.feature_dim) for n in meta.node_types} == {"user": (0, 149, 64), "item": (150, 349, 64)}


def test_plain_directories_of_both_writers(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(0, [1.0], 3)], "global_node_id long, feature_vec array<float>, label int").write.parquet(f"{root}/node_data/user")
    spark.createDataFrame([(5,)], "node_id long").write.parquet(f"{root}/node_data/item")
    spark.createDataFrame([(0, 5, 2.0)], "src long, dst long, edge_weight float").write.parquet(f"{root}/edge_data/user_click_item")
    spark.createDataFrame([(5, 5)], "src_id long, dst_id long").write.parquet(f"{root}/edge_data/item__similar__item")
    meta = {
        "node_types": ["user", "item", "shop"],
        "edge_types": [
            {"src_type": "user", "edge_name": "click", "dst_type": "item"},
            ["item", "similar", "item"],
            {"src_type": "user", "rel_type": "gone", "dst_type": "item", "etype": "user__gone__item"},
        ],
    }
    os.makedirs(f"{root}/metadata_temp")
    with open(f"{root}/metadata_temp/part-00000", "w") as f:
        json.dump(meta, f, indent=2)
    nodes, edges = layout.read_type_dirs(spark, root)
    assert {(r.node_type, r.node_id, r.label) for r in nodes.collect()} == {("user", 0, 3), ("item", 5, None)}
    assert {(r.rel, r.src, r.dst, r.edge_weight) for r in edges.collect()} == {("click", 0, 5, 2.0), ("similar", 5, 5, None)}
    with pytest.raises(FileNotFoundError):
        layout.read_metadata_text(spark, f"{root}/nowhere")


# --- features -----------------------------------------------------------------------------


def file_store(folder, fail_once=False):
    """A key-value store with one file per key, which makes puts repeatable."""

    def connect():
        state = {"failed": not fail_once}

        class Client:
            def put_many(self, batch):
                assert len(batch) <= 50
                if not state["failed"]:
                    state["failed"] = True
                    raise OSError("busy")
                for key, ttl, value in batch:
                    with open(os.path.join(folder, key.replace(":", "_")), "w") as f:
                        f.write(f"{ttl} {value}")

            def close(self):
                pass

        return Client()

    return connect


@pytest.mark.parametrize("fail_once", [False, True])
def test_key_value_sink(spark, graph, tmp_path, fail_once):
    from hetgraph.sinks.keyvalue import write_key_values

    folder = str(tmp_path)
    kv = FE.as_key_values(graph[0])
    assert write_key_values(kv, file_store(folder, fail_once), flush_rows=50) == 350
    assert len(os.listdir(folder)) == 350
    ttl, value = open(os.path.join(folder, "gnn_feat_user_3")).read().split(" ")
    want = graph[0].where("node_type = 'user' and node_id = 3").first().feature_vec
    assert ttl == "86400" and np.allclose(json.loads(value), want)
    assert jobs.sync_features(graph[0].limit(0), file_store(folder)) == 0


def test_lookup_keeps_requests_and_fills_gaps(spark, graph):
    req = spark.createDataFrame([(0, "user", 3), (1, "user", 3), (2, "user", 10**6), (3, "shop", 1)], "pos int, node_type string, node_id long")
    got = FE.get_features(req, graph[0]).orderBy("pos").collect()
    assert [len(r.feature_vec) for r in got] == [64, 64, 256, 256] and got[2].feature_vec == [0.0] * 256
    assert [r.feature_vec is None for r in FE.get_feature(req, graph[0]).orderBy("pos").collect()] == [False, False, True, True]


def test_json_vectors(spark):
    df = spark.createDataFrame([("[0.1, 0.25]",), (None,)], "t string")
    assert [r.v and [round(x, 6) for x in r.v] for r in df.select(FE.decode_vector("t").alias("v")).collect()] == [[0.1, 0.25], None]


def log_rows(spark):
    at = lambda d, h=0: datetime(2024, 1, d, h)
    return spark.createDataFrame(
        [
            ("user", 1, at(5, 1), 1, "old", False),
            ("user", 1, at(5, 9), 2, "new", False),
            ("user", 1, at(5, 2), 3, "late", False),
            ("user", 2, at(3), 4, "expired", False),
            ("user", 3, at(5), 5, "x", False),
            ("user", 3, at(5, 1), 6, None, True),
            ("user", 4, at(5), 8, "first", False),
            ("user", 4, at(5), 9, "tie", False),
            ("user", 5, at(7), 10, "future", False),
        ],
        feature_log.LOG_SCHEMA,
    )


def test_last_write_wins_by_event_time(spark):
    got = {(r.node_id, r.value) for r in FE.latest_features(log_rows(spark), "2024-01-05 12:00:00").collect()}
    assert got == {(1, "new"), (4, "tie")}


def test_stream_equals_batch_in_any_arrival_order(spark, tmp_path):
    log = log_rows(spark)
    now = "2024-01-05 12:00:00"
    want = rows(FE.latest_features(log, now))
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    os.makedirs(src)
    # Newest first, in two runs of the same query: late rows arrive in the second one.
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        log.where(part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(feature_log.LOG_SCHEMA).parquet(src)
        feature_log.append_log(stream, out, ck).awaitTermination()
    stored = feature_log.read_log(spark, out)
    assert stored.count() == log.count()
    assert rows(FE.latest_features(stored, now)) == want
    small = feature_log.compact_log(stored, str(tmp_path / "compact"), now)
    assert small.count() == 5 and rows(FE.latest_features(small, now)) == want
    later = "2024-01-07 12:00:00"
    assert rows(FE.latest_features(small, later)) == rows(FE.latest_features(log, later))


# --- requests -----------------------------------------------------------------------------


def test_request_parsing(spark):
    bodies = [
        '{"node_id": 5}',
        '{"node_id": 6, "node_type": "item", "task_type": "link_predict"}',
        '{"node_type": "item"}',
        '{"node_id": 7, "task_type": "nonsense"}',
        "no json",
    ]
    df = spark.createDataFrame([(i, b.encode()) for i, b in enumerate(bodies)], "i int, body binary")
    got = [tuple(r)[1:] for r in SV.parse_requests(df).orderBy("i").collect()]
    assert got == [
        (5, "user", "node_classify", None),
        (6, "item", "link_predict", None),
        (None, "item", "node_classify", "missing node_id"),
        (7, "user", "nonsense", "unknown task type: nonsense"),
        (None, "user", "node_classify", "missing node_id"),
    ]


def test_batch_scoring_answers_every_request(spark, graph):
    from hetgraph.catalog.models_q import HEAD, INPUTS
    from hetgraph.catalog.serving_q import REQUEST_LAYER

    bodies = ['{"node_id": 1}', '{"node_id": 1}', '{"node_id": 10000000}', '{"node_id": 2, "node_type": "item"}', "{}"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    got = SV.batch_score(
        df, "body", features=graph[0], edges=graph[1], inputs=INPUTS, layers=[REQUEST_LAYER], head=HEAD, fanouts=[4]
    )
    out = {r.i: r for r in got.collect()}
    assert len(out) == 5 and out[0].probabilities == out[1].probabilities
    assert out[2].error == "unknown node" and out[4].error == "missing node_id" and out[3].error is None
    texts = {r.i: json.loads(r.response) for r in SV.as_responses(got).collect()}
    assert texts[0]["node_id"] == 1 and "error" not in texts[0] and texts[4]["error"] == "missing node_id"


def test_two_layer_scoring(spark, graph):
    from hetgraph.catalog.models_q import INPUTS, HEAD
    from hetgraph.operators.layers import SageLayer
    from hetgraph.functions.weights import formula_bias, formula_matrix

    rev = [EdgeType(*e).reverse() for e in CONFIG.edge_types]
    mk = lambda o, i: SageLayer({e: formula_matrix(o, i, 1) for e in rev}, {e: formula_matrix(o, i, 2) for e in rev}, {e: formula_bias(o) for e in rev})
    seeds = graph[0].where("node_type = 'user'").select("node_type", "node_id")
    got = SV.score_seeds(seeds, graph[0], graph[1], INPUTS, [mk(8, 8), mk(4, 8)], HEAD, [3, 2]).collect()
    assert len(got) == 150 and all(abs(sum(r.probabilities) - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("kind", ["sage", "gat", "rgcn"])
def test_full_fanout_scoring_equals_the_encoder(small, kind):
    nodes, edges, _, _ = small
    types = [EdgeType("user", "click", "item"), EdgeType("item", "similar", "item"), EdgeType("item", "sold_to", "user")]
    config = TrainConfig(model_type=kind, hidden_channels=4, num_layers=2, num_heads=2, num_classes=3, target_node_type="item")
    model = L.build_model(config, {"user": 5, "item": 7}, types)
    rng = np.random.default_rng(1)
    norms = [(rng.normal(size=len(g)), rng.normal(size=len(b))) for g, b in model.norms]
    model = dataclasses.replace(model, norms=norms)
    # The blocks hold each link once.
    once = edges.dropDuplicates(["src_type", "rel", "dst_type", "src", "dst"])
    want = {(r.node_type, r.node_id): r.probabilities for r in L.classify(L.encode(model, once, nodes), model.head, "item").collect()}
    seeds = nodes.where("node_type = 'item'").select("node_type", "node_id")
    got = SV.score_seeds(
        seeds, nodes, once, model.inputs, model.layers, model.head, [None, None], direction="in", kind=kind, norms=norms
    ).collect()
    assert {(r.node_type, r.node_id) for r in got} == set(want)
    for r in got:
        np.testing.assert_allclose(r.probabilities, want[r.node_type, r.node_id], rtol=1e-6)


def test_overwrite_drops_types_without_rows(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"))
    schema = "node_type string, global_id long, feature_vec array<float>, label int"
    store.write_nodes(spark.createDataFrame([("user", 1, [1.0], 1), ("item", 2, [1.0], 1)], schema), ["user", "item"])
    assert store.write_nodes(spark.createDataFrame([("user", 3, [1.0], 1)], schema), ["user", "item"]) == {"user": 1, "item": 0}
    assert [(r.node_type, r.node_id) for r in store.read_nodes().collect()] == [("user", 3)]
    masks = "node_type string, node_id long, train_mask boolean"
    assert store.write_split(spark.createDataFrame([("user", 1, True), ("item", 2, True)], masks), "train") == 2
    assert store.write_split(spark.createDataFrame([("user", 1, True), ("item", 2, False)], masks), "train") == 1
    assert [(r.node_type, r.node_id) for r in store.read_split("train").collect()] == [("user", 1)]
    assert GraphStore(spark, str(tmp_path / "none")).read_nodes().collect() == []


def test_both_time_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.sql("SELECT 'user' node_type, 1L node_id, timestamp'2024-01-01' ts, 1L event_id, 'v' value, false deleted").write.parquet(path)
    plan = FE.latest_features(spark.read.parquet(path), "2024-01-02 00:00:00")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "LessThanOrEqual(ts" in pushed and "GreaterThan(ts" in pushed
