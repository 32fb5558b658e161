"""The ways in which attention and SAGE layers move vectors along edges give the same result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hetgraph.operators import layers as L
from hetgraph.runtime import recorded
from hetgraph.schema import EdgeType

KINDS = [EdgeType("a", "to", "b"), EdgeType("b", "near", "b")]


def _graph(spark, different):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(different, 6)).tolist()
    nodes = [(t, i, vectors[(i * 7 + k) % different]) for k, t in enumerate("ab") for i in range(40)]
    h = spark.createDataFrame(nodes, "node_type string, node_id long, h array<double>")
    ends = rng.integers(0, 45, size=(400, 2)).tolist()
    edges = [(*KINDS[i % 2], s, d, 1.0) for i, (s, d) in enumerate(ends)]
    return h, spark.createDataFrame(edges, "src_type string, rel string, dst_type string, src long, dst long, edge_weight double")


def _rows(df):
    return {(r.node_type, r.node_id): np.array(r.h) for r in df.collect()}


def _same(a, b):
    assert a.keys() == b.keys() and len(a) == 80
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("different", [4, 80])
def test_attention_without_a_pass_for_the_maximum(spark, monkeypatch, different):
    h, edges = _graph(spark, different)
    rng = np.random.default_rng(6)
    layer = L.GatLayer(
        project={e: rng.normal(size=(4, 6)) for e in KINDS}, attn_src={e: rng.normal(size=(2, 2)) for e in KINDS},
        attn_dst={e: rng.normal(size=(2, 2)) for e in KINDS}, bias={e: rng.normal(size=4) for e in KINDS},
    )
    with recorded() as tables:
        got = _rows(L.gat_layer(edges, h, layer))
    assert not any("/scores-" in t for t in tables)
    monkeypatch.setattr(L, "SPREAD", -1.0)
    with recorded() as tables:
        exact = _rows(L.gat_layer(edges, h, layer))
    assert any("/scores-" in t for t in tables)
    _same(got, exact)


@pytest.mark.parametrize("reducer", ["mean", "sum"])
def test_a_narrow_layer_moves_its_short_result(spark, monkeypatch, reducer):
    h, edges = _graph(spark, 80)
    rng = np.random.default_rng(7)
    layer = L.SageLayer(
        own={e: rng.normal(size=(2, 6)) for e in KINDS}, neighbor={e: rng.normal(size=(2, 6)) for e in KINDS},
        bias={e: rng.normal(size=2) for e in KINDS}, reducer=reducer,
    )
    lengths = []
    reduce_by = L.reduce_by

    def seen(rows, keys, vec, dim, *more, **others):
        lengths.append(dim)
        return reduce_by(rows, keys, vec, dim, *more, **others)

    monkeypatch.setattr(L, "reduce_by", seen)
    got = _rows(L.sage_layer(edges, h, layer))
    assert lengths == [2]
    state = {(r.node_type, r.node_id): np.array(r.h) for r in h.collect()}
    want = {k: np.zeros(2) for k in state}
    for e in KINDS:
        met = {}
        for r in edges.where((F.col("rel") == e.rel)).collect():
            if ("a" if e.rel == "to" else "b", r.src) in state:
                met.setdefault((r.dst_type, r.dst), []).append(state[r.src_type, r.src])
        for k in state:
            if k[0] == e.dst_type:
                want[k] = want[k] + layer.own[e] @ state[k] + layer.bias[e]
        for k, parts in met.items():
            if k in state:
                want[k] = want[k] + layer.neighbor[e] @ (np.mean(parts, 0) if reducer == "mean" else np.sum(parts, 0))
    _same({k: v for k, v in got.items() if k in want}, want)
