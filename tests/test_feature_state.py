"""Keyed state against the batch form, lookups in buckets, scoring by micro-batch, exact negatives."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from hetgraph.operators import features as FE
from hetgraph.operators import sampling as S
from hetgraph.sinks import feature_tables as FT
from hetgraph.streaming import feature_log, feature_state, scoring

T0 = datetime(2024, 1, 1)
EDGE = "src_type string, rel string, dst_type string, src long, dst long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def parts_of(spark, events, path):
    for i, part in enumerate(events):
        data = [("u", k, T0 + timedelta(hours=h), e, v, d) for k, h, e, v, d in part]
        spark.createDataFrame(data, feature_log.LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{i}")


PARTS = [
    [(1, 0, 1, "a", False), (1, 0, 2, "b", False), (2, 1, 3, "c", False), (3, 2, 4, "d", None), (4, 2, 5, "e", False)],
    [(1, 20, 6, "f", False), (2, 0.5, 7, "late, loses", False), (3, 21, 8, None, True), (5, 15, 9, "late, alive", False)],
    [(6, 50, 10, "g", False), (2, 20, 11, "too late", False), (5, 40, 12, "h", False)],
    [(6, 49, 13, "late, loses", False), (7, 73.999, 14, "i", False), (5, 64, 15, None, True)],
]


def test_state_equals_the_batch_form_after_each_restart(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    seen = []
    for part in PARTS:
        seen += part
        parts_of(spark, [part], f"{source}/{len(seen)}")
        stream = spark.readStream.schema(feature_log.LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        feature_state.keep_state(stream, out, state).awaitTermination()  # a new query each time, from its checkpoint
        log = spark.read.schema(feature_log.LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        now = log.agg(F.max("ts")).first()[0]
        want = FE.latest_features(log.fillna(False), F.lit(now))
        assert rows(feature_state.read_state(spark, state).select(*want.columns)) == rows(want)
    # Expired keys have left the state, not only the view of it.
    stored = spark.read.format("statestore").option("stateVarName", "last").load(state)
    assert {r.key.node_id for r in stored.collect()} == {5, 6, 7}
    changes = [(r.node_id, r.change) for r in spark.read.parquet(out).collect()]
    assert changes.count((1, "put")) == 2 and (1, "expire") in changes and (3, "delete") in changes
    assert (3, "expire") not in changes and changes.count((2, "put")) == 2  # it expires at once


# --- lookups ------------------------------------------------------------------------------


def test_bucketed_lookup_exchanges_keys_only(spark, tmp_path):
    feats = spark.range(5000).select(
        F.lit("user").alias("node_type"), F.col("id").alias("node_id"), F.array(F.col("id").cast("float")).alias("feature_vec")
    )
    feats = feats.unionByName(spark.createDataFrame([("user", None, [1.0]), ("user", 9000, None)], "node_type string, node_id long, feature_vec array<float>"))
    path = str(tmp_path / "features")
    FT.write_features(feats, path, 8)
    stored = FT.open_features(spark, path, 8)
    asked = spark.createDataFrame([(i, "user", k) for i, k in enumerate([3, 3, 4999, 7777, None, 9000] + [11] * 500)], "i int, node_type string, node_id long")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = FT.lookup(asked, stored, 2)
        got = {r.i: r.feature_vec for r in found.collect()}
        plan = stored.join(asked.select(*FT.KEYS).distinct(), FT.KEYS, "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert [got[i] for i in range(6)] == [[3.0], [3.0], [4999.0], [0, 0], [0, 0], [0, 0]] and got[100] == [11.0]
    side = plan[: plan.index("Exchange")]
    assert "FileScan parquet" in side and "Bucketed: true" in side and "SelectedBucketsCount: 8 out of 8" in side
    assert FT.bucket_sizes(stored, 8).agg(F.sum("vectors")).first()[0] == 5000


# --- scoring by micro-batch ---------------------------------------------------------------


def test_micro_batches_reduce_the_features_and_write_once(spark, graph, tmp_path):
    from hetgraph.catalog.models_q import MLP

    features = str(tmp_path / "features")
    graph[0].write.parquet(features)
    features = spark.read.parquet(features)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(3):
        spark.createDataFrame([(i * 10 + k, f'{{"node_id": {k}}}') for k in range(10)], "i int, body string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("i int, body string").parquet(source)
        scoring.score_stream(stream, features, MLP, out, state).awaitTermination()
    answers = spark.read.parquet(out)
    assert answers.count() == 30 and answers.select("batch").distinct().count() == 3
    # A batch that runs again replaces what it wrote before.
    again = spark.createDataFrame([(k, f'{{"node_id": {k}}}') for k in range(10)], "i int, body string")
    scoring.score_batch(again, 0, features, MLP, out)
    assert spark.read.parquet(out).count() == 30
    want = {r.i: r.response for r in scoring.score_requests(again, features, MLP).collect()}
    assert {r.i: r.response for r in spark.read.parquet(out).where("batch = 0").collect()} == want
    # The plan of a batch: features meet the distinct keys before anything else, and those are broadcast.
    plan = scoring.score_requests(again, features, MLP)._jdf.queryExecution().executedPlan().toString()
    semi = plan[plan.index("LeftSemi") :]
    assert "feature_vec" in semi[: semi.index("FileScan parquet") + 400]


# --- exact negatives ----------------------------------------------------------------------


def test_exact_negatives(spark):
    rng = np.random.default_rng(3)
    ranges = spark.createDataFrame([("t", 100, 60), ("s", 0, 9)], "node_type string, start_id long, num_ids long")
    links = {0: list(range(100, 160)), 1: list(range(100, 157)), 2: [], 3: list(range(130, 160)), 4: [159], 5: [5, 500, 120]}
    links[6] = sorted(rng.choice(60, 40, replace=False) + 100)
    edges = [("s", "r", "t", s, int(d)) for s, ds in links.items() for d in ds] + [("s", "r", "x", 0, 1), ("s", "r", "t", None, 101)]
    table = spark.createDataFrame(edges + edges[:30], EDGE)
    for k in (1, 5, 100):
        got = {}
        for r in S.exact_negatives(table, ranges, k, 7).collect():
            got.setdefault((r.src, r.dst), []).append(r.negative)
        for s, ds in links.items():
            free = set(range(100, 160)) - set(ds)
            for d in ds:
                mine = got.pop((s, d), [])
                assert len(mine) == len(set(mine)) == min(k, len(free)) and set(mine) <= free
        assert not got
    once = S.exact_negatives(table, ranges, 3, 7)
    assert rows(once) == rows(S.exact_negatives(table.repartition(7), ranges, 3, 7))
    assert S.exact_negatives(table.limit(0), ranges, 3).collect() == []
    # Every candidate of a source is about as likely.
    many = spark.createDataFrame([("s", "r", "t", 1, 100 + i) for i in range(50)], EDGE)
    counts = np.zeros(10)
    for seed in range(4):
        for r in S.exact_negatives(many, ranges, 2, seed).collect():
            counts[r.negative - 150] += 1
    assert counts.sum() == 400 and abs(counts - 40).max() < 26
