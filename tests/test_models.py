import numpy as np
import pytest
from pyspark.sql import functions as F

from hetgraph.functions import vectors as V
from hetgraph.functions.weights import weights_from_table, weights_to_table
from hetgraph.operators import layers as L
from hetgraph.operators import metrics as M
from hetgraph.operators import propagate as PR
from hetgraph.operators import training as TR
from hetgraph.schema import EdgeType, TrainConfig

ETYPES = [EdgeType("user", "click", "item"), EdgeType("item", "similar", "item"), EdgeType("item", "sold_to", "user")]


# --- numpy twins --------------------------------------------------------------------------


def in_neighbors(pairs, etype, node):
    return [s for s, d in pairs[tuple(etype)] if d == node]


def np_norm(x, norm):
    g, b = norm
    return (x - x.mean()) / np.sqrt(x.var() + 1e-5) * g + b


def np_layer(kind, layer, h, pairs):
    out = {}
    for (t, i), x in h.items():
        if kind == "rgcn":
            acc = layer.self_loop @ x + layer.bias
            for e in ETYPES:
                if e.dst_type == t:
                    for s in in_neighbors(pairs, e, i):
                        acc = acc + layer.relation[e] @ h[(e.src_type, s)]
        elif kind == "sage":
            acc = np.zeros(layer.out_dim)
            for e in ETYPES:
                if e.dst_type == t:
                    acc = acc + layer.own[e] @ x + layer.bias[e]
                    near = [h[(e.src_type, s)] for s in in_neighbors(pairs, e, i)]
                    if near:
                        acc = acc + layer.neighbor[e] @ np.mean(near, axis=0)
        else:
            heads, dim = layer.heads, layer.dim
            acc = np.zeros(heads * dim)
            for e in ETYPES:
                if e.dst_type != t:
                    continue
                acc = acc + layer.bias[e]
                if e in layer.residual:
                    acc = acc + layer.residual[e] @ x
                near = [h[(e.src_type, s)] for s in in_neighbors(pairs, e, i)]
                if not near:
                    continue
                own = (layer.project[e] @ x).reshape(heads, dim)
                msg = np.stack([(layer.project[e] @ u).reshape(heads, dim) for u in near])
                score = (msg * layer.attn_src[e]).sum(-1) + (own * layer.attn_dst[e]).sum(-1)
                score = np.where(score > 0, score, 0.2 * score)
                w = np.exp(score - score.max(0))
                w /= w.sum(0)
                acc = acc + (w[:, :, None] * msg).sum(0).reshape(-1)
        out[(t, i)] = acc
    return out


def np_encode(model, feats, pairs):
    h = {k: model.inputs[k[0]][0] @ x + model.inputs[k[0]][1] for k, x in feats.items()}
    for i, layer in enumerate(model.layers):
        h = np_layer(model.kind, layer, h, pairs)
        last = i + 1 == len(model.layers)
        if not last or model.kind == "rgcn":
            h = {k: np_norm(x, model.norms[i]) for k, x in h.items()}
        if not last:
            act = (lambda x: np.where(x > 0, x, np.expm1(x))) if model.kind == "gat" else (lambda x: np.maximum(x, 0))
            h = {k: act(x) for k, x in h.items()}
    return h


@pytest.mark.parametrize("kind", ["sage", "gat", "rgcn"])
def test_three_layers_equal_numpy(small, kind):
    nodes, edges, feats, pairs = small
    config = TrainConfig(model_type=kind, hidden_channels=6, num_layers=3, num_heads=2, num_classes=4, target_node_type="item")
    model = L.build_model(config, {"user": 5, "item": 7}, ETYPES)
    want = np_encode(model, feats, pairs)
    h = L.encode(model, edges, nodes)
    got = {(r.node_type, r.node_id): np.array(r.h) for r in h.collect()}
    assert set(got) == set(want)
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-6, atol=1e-9)
    scored = L.classify(h, model.head, "item").collect()
    assert len(scored) == 6
    for r in scored:
        z = want[("item", r.node_id)]
        z = model.head[1][0] @ np.maximum(model.head[0][0] @ z + model.head[0][1], 0) + model.head[1][1]
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        np.testing.assert_allclose(r.probabilities, p, rtol=1e-6)
        assert r.prediction == p.argmax() and abs(sum(r.probabilities) - 1) < 1e-9
    with pytest.raises(ValueError):
        L.classify(h, model.head, "shop")


def test_unknown_model_and_missing_dims():
    with pytest.raises(ValueError):
        L.build_model(TrainConfig(model_type="mlp"), {"user": 5}, ETYPES)
    model = L.build_model(TrainConfig(hidden_channels=6), {"user": 5}, ETYPES)
    assert model.inputs["item"][0].shape == (6, 6) and model.inputs["user"][0].shape == (6, 5)


def test_attention_sums_to_one(small):
    nodes, edges, _, _ = small
    model = L.build_model(TrainConfig(model_type="gat", hidden_channels=4, num_heads=3), {"user": 5, "item": 7}, ETYPES)
    h = L.input_projection(nodes, model.inputs, "feature_vec")
    rows = L.attention_weights(edges, h, model.layers[0]).collect()
    assert len(rows) == edges.count()
    total = {}
    for r in rows:
        total.setdefault((r.rel, r.dst), []).append(r.alpha)
    for parts in total.values():
        np.testing.assert_allclose(np.sum(parts, axis=0), 1.0)


def test_attention_survives_large_scores(small):
    nodes, edges, _, _ = small
    model = L.build_model(TrainConfig(model_type="gat", hidden_channels=4, num_heads=1, num_layers=1), {"user": 5, "item": 7}, ETYPES)
    layer = model.layers[0]
    layer.attn_src = {e: a * 1e5 for e, a in layer.attn_src.items()}
    h = L.input_projection(nodes, model.inputs, "feature_vec")
    assert all(np.isfinite(r.h).all() for r in L.gat_layer(edges, h, layer).collect())


def test_pool_and_gcn_reducers(small):
    nodes, edges, feats, pairs = small
    rng = np.random.default_rng(0)
    h = L.input_projection(nodes, {"user": (rng.normal(size=(3, 5)), None), "item": (rng.normal(size=(3, 7)), None)}, "feature_vec")
    state = {(r.node_type, r.node_id): np.array(r.h) for r in h.collect()}
    mk = lambda *s: {e: rng.normal(size=s) for e in ETYPES}
    pool = {e: (rng.normal(size=(5, 3)), rng.normal(size=5)) for e in ETYPES}
    layer = L.SageLayer(mk(2, 3), mk(2, 5), mk(2), "pool", pool)
    got = {(r.node_type, r.node_id): np.array(r.h) for r in L.sage_layer(edges, h, layer).collect()}
    for (t, i), x in state.items():
        acc = np.zeros(2)
        for e in ETYPES:
            if e.dst_type == t:
                acc += layer.own[e] @ x + layer.bias[e]
                near = [np.maximum(pool[e][0] @ state[(e.src_type, s)] + pool[e][1], 0) for s in in_neighbors(pairs, e, i)]
                if near:
                    acc += layer.neighbor[e] @ np.max(near, axis=0)
        np.testing.assert_allclose(got[(t, i)], acc, rtol=1e-6, atol=1e-9)
    for r in PR.neighbor_gcn(edges, h, 3).collect():
        near = [state[(r.src_type, s)] for s in in_neighbors(pairs, (r.src_type, r.rel, r.dst_type), r.dst)]
        np.testing.assert_allclose(r.m, (np.sum(near, axis=0) + state[(r.dst_type, r.dst)]) / (len(near) + 1), rtol=1e-6)
    rows = PR.neighbor_gcn(edges, h, 3).collect()
    assert len(rows) == sum(len([1 for t, _ in state if t == e.dst_type]) for e in ETYPES)
    with pytest.raises(ValueError):
        PR.reduce_neighbors(edges, h, 3, "lstm")


@pytest.mark.parametrize("dim", [5, 65])
def test_vectors_are_never_cut_or_shifted(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i % 3, rng.normal(size=dim).tolist(), [0.5 + i, 1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, v array<double>, w array<double>")
    for how, f in (("sum", np.sum), ("mean", np.mean), ("max", np.max), ("min", np.min)):
        want = {k: f([v for j, v, _ in rows if j == k], axis=0) for k in range(3)}
        for width in (3, 7, 64, 512):
            for r in V.reduce_by(df, ["k"], "v", dim, how, width=width).collect():
                np.testing.assert_allclose(r.m, want[r.k], rtol=1e-9)
    from pyspark.errors import PySparkException

    for bad in ([1.0] * (dim - 1), [1.0] * (dim + 1), None, [1.0] * (dim - 1) + [None]):
        wrong = df.unionByName(spark.createDataFrame([(1, bad, [1.0, 1.0])], df.schema))
        for width in (3, 512):
            with pytest.raises(PySparkException):
                V.reduce_by(wrong, ["k"], "v", dim, width=width).collect()


def test_block_diagonal_relation():
    parts = np.arange(12, dtype=float).reshape(2, 2, 3)
    layer = L.RgcnLayer.from_blocks({ETYPES[0]: parts}, np.zeros((4, 6)), np.zeros(4))
    w = layer.relation[ETYPES[0]]
    assert w.shape == (4, 6) and (w[:2, :3] == parts[0]).all() and (w[2:, 3:] == parts[1]).all() and w[:2, 3:].sum() == 0


def test_link_scores_equal_the_joined_network(small):
    nodes, edges, _, _ = small
    rng = np.random.default_rng(1)
    h = L.input_projection(nodes, {"user": (rng.normal(size=(4, 5)), None), "item": (rng.normal(size=(4, 7)), None)}, "feature_vec")
    state = {(r.node_type, r.node_id): np.array(r.h) for r in h.collect()}
    net = [(rng.normal(size=(3, 8)), rng.normal(size=3)), (rng.normal(size=(1, 3)), rng.normal(size=1))]
    for r in L.link_scores(edges, h.where("node_id <> 4"), net).collect():
        x = np.concatenate([state[(r.src_type, r.src)], state[(r.dst_type, r.dst)]])
        want = net[1][0] @ np.maximum(net[0][0] @ x + net[0][1], 0) + net[1][1]
        assert abs(r.score - want[0]) < 1e-9 and 4 not in (r.src, r.dst)


# --- vectors ------------------------------------------------------------------------------


def test_vector_functions_on_odd_input(spark):
    rows = [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [1000.0, 1000.0])]
    df = spark.createDataFrame(rows, "k int, v array<float>")
    out = {r.k: r for r in df.select("k", V.l2_normalize("v").alias("n"), V.softmax("v").alias("s"), V.argmax("v").alias("a")).collect()}
    assert out[1].n == [0.6, 0.8] and out[2].n == [0.0, 0.0] and out[3].n is None
    assert out[4].s == [0.5, 0.5] and out[4].a == 0 and out[3].s is None and out[1].a == 1


def test_dense_keeps_unknown_types_and_nulls(spark):
    rows = [("a", [1.0, 2.0]), ("b", [5.0]), ("c", [7.0, 8.0, 9.0]), ("a", None), ("a", [0.0, 1.0]), ("c", [])]
    df = spark.createDataFrame(rows, "t string, v array<double>").coalesce(1)
    w = {"a": [(np.array([[1.0, 1.0]]), np.array([0.5]))], "b": [(np.array([[2.0], [3.0]]), None)]}
    got = [r.o for r in df.select(V.dense(w, "t", "v").alias("o")).collect()]
    assert got == [[3.5], [10.0, 15.0], [7.0, 8.0, 9.0], None, [1.5], []]


def test_weights_table_round_trip(spark):
    w = {(0, "user", "input"): (np.eye(2), np.ones(2)), (1, "a__b__c", "own"): (np.ones((1, 3)), None)}
    back = weights_from_table(weights_to_table(spark, w))
    assert set(back) == set(w) and back[(1, "a__b__c", "own")][1] is None
    assert (back[(0, "user", "input")][0] == np.eye(2)).all()


# --- metrics and rules --------------------------------------------------------------------


def test_metrics_with_empty_denominators(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)] + [(0, 3)], "label int, prediction int")
    m = M.classification_metrics(rows).first()
    # Class 2 is never predicted and class 3 never true: both count as 0.
    assert m.num_classes == 4 and abs(m.accuracy - 0.4) < 1e-12
    assert abs(m.precision - (1 + 1 / 3 + 0 + 0) / 4) < 1e-12 and abs(m.recall - (1 / 3 + 1 + 0 + 0) / 4) < 1e-12
    f1 = (0.5 + 0.5) / 4
    assert abs(m.f1 - f1) < 1e-12
    empty = spark.createDataFrame([], "v double, n long")
    assert M.sync_metric(empty, "v", "n").first().metric == 0.0


def test_reduce_arrays(spark):
    df = spark.createDataFrame([("a", [1.0, 5.0]), ("a", [3.0, 1.0])], "k string, v array<double>")
    get = lambda op: M.reduce_arrays(df, ["k"], "v", 2, op).first().v
    assert get("sum") == [4.0, 6.0] and get("mean") == [2.0, 3.0] and get("max") == [3.0, 5.0] and get("min") == [1.0, 1.0]
    with pytest.raises(ValueError):
        get("median")


def stop_by_hand(scores, patience, delta, mode):
    best, misses = None, 0
    for i, s in enumerate(scores):
        if best is None:
            best = s
            continue
        better = s > best + delta if mode == "max" else s < best - delta
        best, misses = (s, 0) if better else (best, misses + 1)
        if misses >= patience:
            return i
    return None


def rate_by_hand(scores, lr, factor, patience):
    best, misses, out = None, 0, []
    for s in scores:
        if best is None or s > best * 1.0001:
            best, misses = s, 0
        else:
            misses += 1
        if misses > patience:
            lr, misses = lr * factor, 0
        out.append(lr)
    return out


def test_run_rules_equal_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    runs = {r: np.round(rng.uniform(0, 1, 40), 2).tolist() for r in range(20)}
    runs[20] = [0.5, 0.505, 0.51, 0.515, 0.52, 0.6]
    df = spark.createDataFrame([(r, i, s) for r, ss in runs.items() for i, s in enumerate(ss)], "run_id int, epoch int, score double")
    for mode, delta in (("max", 0.0), ("max", 0.011), ("min", 0.05)):
        got = {r.run_id: r.stop_epoch for r in TR.early_stop(df, 3, delta, mode).collect()}
        assert got == {r: stop_by_hand(s, 3, delta, mode) for r, s in runs.items()}
    lr = {}
    for r in sorted(TR.lr_schedule(df, 1.0, 0.5, 2).collect(), key=lambda r: r.epoch):
        lr.setdefault(r.run_id, []).append(r.lr)
    assert lr == {r: rate_by_hand(s, 1.0, 0.5, 2) for r, s in runs.items()}
    best = {r.run_id: (r.best_epoch, r.best_score) for r in TR.best_epoch(df).collect()}
    assert best == {r: (int(np.argmax(s)), max(s)) for r, s in runs.items()}
    zero = spark.createDataFrame([(1, 0, 0.0)], "run_id int, epoch int, score double")
    assert tuple(TR.best_epoch(zero).first()) == (1, None, 0.0)


def test_training_on_propagated_features(spark, graph):
    # Labels follow the embedding index in blocks, so use a label that the features do carry.
    nodes = graph[0].withColumn("label", (F.col("feature_vec")[0] > 0).cast("int"))
    config = TrainConfig(target_node_type="item")
    data = TR.graph_features(nodes, graph[1], 64, 1, config)
    assert len(data.first().features) == 128
    model = TR.fit_classifier(data.where("train_mask"), maxIter=30)
    report = {r.split: r for r in TR.evaluate(TR.predict(model, data)).collect()}
    assert set(report) == {"train", "val", "test"} and report["train"].accuracy > 0.95
    mlp = TR.fit_mlp(data.where("train_mask"), [128, 4, 2], maxIter=5, seed=1)
    assert TR.predict(mlp, data).where("prediction is null").count() == 0


@pytest.mark.parametrize("width", [3, 7, 64])
def test_long_vectors_are_cut_and_joined(spark, width):
    rng = np.random.default_rng(2)
    rows = [(int(k), rng.normal(size=10).tolist(), rng.uniform(0.1, 1, 2).tolist()) for k in rng.integers(0, 4, 60)]
    df = spark.createDataFrame(rows, "k int, v array<double>, w array<double>")
    of = lambda k: (np.array([v for x, v, _ in rows if x == k]), np.array([w for x, _, w in rows if x == k]))
    for how, f in (("sum", np.sum), ("mean", np.mean), ("max", np.max), ("min", np.min)):
        got = V.reduce_by(df, ["k"], "v", 10, how, width=width).collect()
        assert len(got) == 4
        for r in got:
            np.testing.assert_allclose(r.m, f(of(r.k)[0], axis=0))
            assert r.n == len(of(r.k)[0])
    for r in V.weighted_mean_by(df, ["k"], "v", "w", 2, 5, width=width).collect():
        v, w = of(r.k)
        want = (v.reshape(-1, 2, 5) * w[:, :, None]).sum(0) / w.sum(0)[:, None]
        np.testing.assert_allclose(r.m, want.reshape(-1))
