"""Graph layers over whole graphs: SAGE, attention and relational layers, heads and link scores.

Every layer handles all edge types in one plan. Where a layer is linear in the neighbours,
neighbours are reduced first and multiplied after, so that matrices meet one row per node
and edge type instead of one per edge.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.functions.vectors import (
    Linear,
    activate,
    argmax,
    dense,
    layer_norm,
    leaky_relu,
    reduce_by,
    softmax,
    weighted_mean_by,
)
from hetgraph.functions.weights import random_linear
from hetgraph.operators.propagate import RELATION, TARGET, reduce_neighbors, shared_states, shares_vectors, sum_vectors
from hetgraph.runtime import materialize
from hetgraph.schema import EdgeType, TrainConfig, etype_name, is_etype

Norm = tuple[np.ndarray, np.ndarray]


@dataclass
class SageLayer:
    """Per edge type the matrices of the own state and of the neighbours, and a bias."""

    own: dict[EdgeType, np.ndarray]
    neighbor: dict[EdgeType, np.ndarray]
    bias: dict[EdgeType, np.ndarray]
    reducer: str = "mean"
    # Dense layer in front of the ``pool`` reducer, per edge type.
    pool: dict[EdgeType, Linear] = field(default_factory=dict)

    @property
    def out_dim(self) -> int:
        return next(iter(self.neighbor.values())).shape[0]

    @property
    def in_dim(self) -> int:
        return next(iter(self.neighbor.values())).shape[1]


@dataclass
class GatLayer:
    """Per edge type one projection, the two attention vectors per head, and a bias."""

    project: dict[EdgeType, np.ndarray]  # (heads * dim, in)
    attn_src: dict[EdgeType, np.ndarray]  # (heads, dim)
    attn_dst: dict[EdgeType, np.ndarray]
    bias: dict[EdgeType, np.ndarray]
    residual: dict[EdgeType, np.ndarray] = field(default_factory=dict)  # (heads * dim, in)

    @property
    def heads(self) -> int:
        return next(iter(self.attn_src.values())).shape[0]

    @property
    def dim(self) -> int:
        return next(iter(self.attn_src.values())).shape[1]


@dataclass
class RgcnLayer:
    """Per edge type one matrix, the self loop that every node gets once, and a bias."""

    relation: dict[EdgeType, np.ndarray]
    self_loop: np.ndarray
    bias: np.ndarray

    @staticmethod
    def from_bases(coefficients: dict[EdgeType, np.ndarray], bases: np.ndarray, self_loop, bias) -> "RgcnLayer":
        """``W_r = sum_b a_rb V_b``; ``bases`` is (num_bases, out, in)."""
        mixed = {e: np.tensordot(a, bases, axes=1) for e, a in coefficients.items()}
        return RgcnLayer(mixed, self_loop, bias)

    @staticmethod
    def from_blocks(blocks: dict[EdgeType, np.ndarray], self_loop, bias) -> "RgcnLayer":
        """Block-diagonal ``W_r``; ``blocks[r]`` is (num_blocks, out/num_blocks, in/num_blocks)."""

        def diagonal(parts):
            n, o, i = parts.shape
            full = np.zeros((n * o, n * i))
            for k in range(n):
                full[k * o : (k + 1) * o, k * i : (k + 1) * i] = parts[k]
            return full

        return RgcnLayer({e: diagonal(p) for e, p in blocks.items()}, self_loop, bias)


# --- one layer ----------------------------------------------------------------------------


def input_projection(h: DataFrame, weights: dict[str, Linear], vec: str = "h") -> DataFrame:
    """Linear layer per node type; a type without weights passes through."""
    return h.select("node_type", "node_id", dense({t: [w] for t, w in weights.items()}, "node_type", vec).alias("h"))


def _name(etypes: dict) -> dict:
    return {EdgeType(*e).name: v for e, v in etypes.items()}


def _own_terms(h: DataFrame, per_etype: dict[EdgeType, Linear], out_dim: int) -> DataFrame:
    """Each node's own term, summed over the edge types that point at its type.

    The sum over edge types is taken on the matrices. A type that no edge type points at has
    no such term and starts from zeros.
    """
    by_type: dict[str, Linear] = {}
    for etype, (w, b) in per_etype.items():
        t = EdgeType(*etype).dst_type
        if t in by_type:
            by_type[t] = (by_type[t][0] + w, by_type[t][1] + b)
        else:
            by_type[t] = (w, b)
    zeros = F.array_repeat(F.lit(0.0), out_dim)
    targets = F.col("node_type").isin(list(by_type))
    return h.select(
        "node_type",
        "node_id",
        F.when(targets, dense({t: [w] for t, w in by_type.items()}, "node_type", "h")).otherwise(zeros).alias("h"),
    )


def _as_node(rows: DataFrame, vec: str) -> DataFrame:
    return rows.select(F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id"), F.col(vec).alias("h"))


def sage_layer(edges: DataFrame, h: DataFrame, layer: SageLayer) -> DataFrame:
    """Sum over edge types of ``W_own h_v + W_neighbor reduce(h_u) + b``.

    Own terms and neighbour terms are stacked and summed by node in one aggregation, so no
    join back to the nodes is needed.
    """
    known = edges.where(is_etype(layer.neighbor))
    if layer.reducer == "pool":
        # The dense layer belongs to the edge type: one copy of the source state per edge type.
        pooled = _per_etype(h, layer.neighbor, "src").select(
            "src_type", "rel", "dst_type", "src",
            activate(dense({k: [v] for k, v in _name(layer.pool).items()}, etype_name(), "h"), "relu").alias("h"),
        )
        dim = next(iter(layer.pool.values()))[0].shape[0]
        met = known.select("src_type", "rel", "dst_type", "src", "dst").join(
            pooled, ["src_type", "rel", "dst_type", "src"]
        )
        reduced = reduce_by(met, RELATION, "h", dim, "max")
    else:
        reduced = None
    matrices = {k: [(w, None)] for k, w in _name(layer.neighbor).items()}
    if reduced is None and layer.reducer in ("mean", "sum") and layer.out_dim < layer.in_dim:
        h = materialize(h.select("node_type", "node_id", "h"), "states")
        if not shares_vectors(h, layer.in_dim):
            # Multiplied first, since the result is shorter and an edge moves it.
            short = _per_etype(h, layer.neighbor, "src").select(
                "src_type", "rel", "dst_type", "src", dense(matrices, etype_name(), "h").alias("h")
            )
            met = known.select("src_type", "rel", "dst_type", "src", "dst").join(short, ["src_type", "rel", "dst_type", "src"])
            neighbor = reduce_by(met, RELATION, "h", layer.out_dim, layer.reducer).select(*RELATION, F.col("m").alias("h"))
            return _with_own_terms(h, neighbor, layer)
    if reduced is None:
        reduced = reduce_neighbors(known, h, layer.in_dim, layer.reducer)
    return _with_own_terms(h, reduced.select(*RELATION, dense(matrices, etype_name(), "m").alias("h")), layer)


def _with_own_terms(h: DataFrame, neighbor: DataFrame, layer: SageLayer) -> DataFrame:
    own = {e: (layer.own.get(e, np.zeros_like(w)), layer.bias[e]) for e, w in layer.neighbor.items()}
    stacked = _own_terms(h, own, layer.out_dim).unionByName(_as_node(neighbor, "h"))
    return sum_vectors(stacked, ["node_type", "node_id"], "h", layer.out_dim)


def _per_etype(h: DataFrame, etypes: dict, end: str) -> DataFrame:
    """One copy of the state per edge type in which the node can stand at ``end``."""
    listed: dict[str, list] = {}
    for e in etypes:
        e = EdgeType(*e)
        listed.setdefault(getattr(e, f"{end}_type"), []).append(e)
    arrays = F.lit(None)
    for t, es in listed.items():
        values = F.array(
            *[F.struct(*[F.lit(getattr(e, c)).alias(c) for c in ("src_type", "rel", "dst_type")]) for e in es]
        )
        arrays = F.when(F.col("node_type") == t, values).otherwise(arrays)
    return (
        h.where(F.col("node_type").isin(list(listed)))
        .select(F.col("node_id").alias(end), "h", F.explode(arrays).alias("__e"))
        .select("__e.*", end, "h")
    )


def attention_scores(edges: DataFrame, h: DataFrame, layer: GatLayer) -> DataFrame:
    """Per edge and head the raw score ``LeakyReLU(a_s . W h_u + a_d . W h_v)``.

    The two scalars per head are linear in the state, so they are computed once per node and
    edge type; edges only add them up.
    """
    heads, dim = layer.heads, layer.dim

    def scalars(attn):
        return {
            e: np.einsum("hd,hdi->hi", attn[e], layer.project[e].reshape(heads, dim, -1)) for e in layer.project
        }

    def side(end, attn, alias):
        folded = {EdgeType(*e).name: [(w, None)] for e, w in scalars(attn).items()}
        return _per_etype(h, layer.project, end).select(
            "src_type", "rel", "dst_type", end, dense(folded, etype_name(), "h").alias(alias)
        )

    return (
        edges.select("src_type", "rel", "dst_type", "src", "dst")
        .join(side("src", layer.attn_src, "s"), ["src_type", "rel", "dst_type", "src"])
        .join(side("dst", layer.attn_dst, "d"), ["src_type", "rel", "dst_type", "dst"])
        .select(
            *RELATION[:3],
            "src",
            "dst",
            F.zip_with("s", "d", lambda a, b: leaky_relu(a + b)).alias("e"),
        )
    )


def _edge_exponents(edges: DataFrame, h: DataFrame, layer: GatLayer) -> DataFrame:
    """Edges with ``exp(score - max)`` per head, the maximum being that of target and edge type."""
    scores = materialize(attention_scores(edges, h, layer), "scores")
    top = reduce_by(scores, RELATION, "e", layer.heads, "max", "top")
    return scores.join(top, RELATION).select(
        *RELATION[:3], "src", "dst", F.zip_with("e", "top", lambda a, t: F.exp(a - t)).alias("w")
    )


def attention_weights(edges: DataFrame, h: DataFrame, layer: GatLayer) -> DataFrame:
    """Per edge the softmax over the in-edges of its target and edge type, one value per head."""
    powers = materialize(_edge_exponents(edges, h, layer), "powers")
    total = reduce_by(powers, RELATION, "w", layer.heads, "sum", "z")
    return powers.join(total, RELATION).select(
        *RELATION[:3], "src", "dst", F.zip_with("w", "z", lambda a, z: a / z).alias("alpha")
    )


#: Largest difference of two source scores at which ``exp`` of it is still far from the smallest double.
SPREAD = 600.0


def _bounds(rows: DataFrame, layer: GatLayer) -> dict[str, list[float]] | None:
    """Per edge type the largest source score of each head; nothing if scores lie too far apart to be measured from it.

    Comes to the driver as one row per edge type.
    """
    heads, width = layer.heads, layer.heads * layer.dim
    ends = [f(F.get("x", F.lit(width + k))).alias(f"{n}{k}") for k in range(heads) for n, f in (("hi", F.max), ("lo", F.min))]
    tops = {}
    for r in rows.groupBy(etype_name().alias("etype")).agg(*ends).collect():
        if not all(r[f"hi{k}"] is not None and r[f"hi{k}"] - r[f"lo{k}"] <= SPREAD for k in range(heads)):
            return None
        tops[r["etype"]] = [r[f"hi{k}"] for k in range(heads)]
    return tops


def _powers(tops: dict[str, list[float]], layer: GatLayer, times: str | None = None):
    """``exp`` of the score above the bound of its target, per head, out of ``x`` of the source and ``d`` of the target."""
    width = layer.heads * layer.dim
    top = F.create_map(*[c for n, v in tops.items() for c in (F.lit(n), F.array(*map(F.lit, v)))])[etype_name()]
    scores = F.slice("x", width + 1, layer.heads)
    raw = F.zip_with(scores, "d", lambda s, d: leaky_relu(s + d))
    powers = F.zip_with(raw, F.zip_with(top, "d", lambda t, d: leaky_relu(t + d)), lambda e, t: F.exp(e - t))
    return powers if times is None else F.transform(powers, lambda w: w * F.col(times))


def _attended(edges: DataFrame, h: DataFrame, layer: GatLayer) -> DataFrame:
    """``RELATION, m``: the weighted sum of the sources' projections per target and edge type.

    A softmax may be measured from any number that its scores share. The score grows with the source's part of it, so the largest such part of an
    edge type bounds the scores of a target without a look at its links: an edge moves to its target once, with projection and score of
    its source. Where scores lie so far apart that this could lose them, the maximum of each target is looked up. If nodes share their
    vectors, edges carry codes, which are counted per target (see ``propagate``).
    """
    heads, dim = layer.heads, layer.dim
    width = heads * dim
    in_dim = next(iter(layer.project.values())).shape[1]
    scores = lambda attn, e: np.einsum("hd,hdi->hi", attn[e], layer.project[e].reshape(heads, dim, -1))
    sent = {e: np.vstack([layer.project[e], scores(layer.attn_src, e)]) for e in layer.project}

    def side(states, end, matrices, name):
        held = _per_etype(states, layer.project, end)
        return held.select(*RELATION[:3], end, dense({k: [(w, None)] for k, w in _name(matrices).items()}, etype_name(), "h").alias(name))

    links = edges.select("src_type", "rel", "dst_type", "src", "dst")
    received = {e: scores(layer.attn_dst, e) for e in layer.project}
    h = materialize(h.select("node_type", "node_id", "h"), "states")
    shared = shared_states(h, max(in_dim, len(layer.project) * (width + heads)))
    if shared is None:
        states = h
    else:
        coded, vectors = shared
        states = coded.select("node_type", "code").distinct().join(F.broadcast(vectors), "code")
        states = materialize(states.select("node_type", F.col("code").alias("node_id"), "h"), "states")
    source = side(states, "src", sent, "x")
    tops = _bounds(source, layer)
    if tops is None:
        projected = source.select(*RELATION[:3], "src", F.slice("x", 1, width).alias("p"))
        if shared is not None:
            projected = side(h, "src", layer.project, "p")
        weighted = _edge_exponents(edges, h, layer).join(projected, ["src_type", "rel", "dst_type", "src"])
        return weighted_mean_by(weighted, RELATION, "p", "w", heads, dim)
    if not tops:
        return source.select(*RELATION[:3], F.col("src").alias("dst"), F.col("x").alias("m")).limit(0)
    if shared is None:
        met = links.join(source, ["src_type", "rel", "dst_type", "src"]).join(side(h, "dst", received, "d"), RELATION)
        weighted = met.select(*RELATION, F.slice("x", 1, width).alias("p"), _powers(tops, layer).alias("w"))
        return weighted_mean_by(weighted, RELATION, "p", "w", heads, dim)
    named = lambda end: coded.select(F.col("node_type").alias(f"{end}_type"), F.col("node_id").alias(end), "code")
    tallies = (
        links.join(named("src"), ["src_type", "src"]).groupBy(*RELATION, F.col("code").alias("src")).agg(F.count(F.lit(1)).alias("times"))
    )
    met = tallies.repartition("dst_type", "dst").join(named("dst"), ["dst_type", "dst"])
    target = side(states, "dst", received, "d").withColumnRenamed("dst", "code")
    met = met.join(F.broadcast(source), ["src_type", "rel", "dst_type", "src"]).join(F.broadcast(target), [*RELATION[:3], "code"])
    weighted = met.select(*RELATION, F.slice("x", 1, width).alias("p"), _powers(tops, layer, "times").alias("w"))
    return weighted_mean_by(weighted, RELATION, "p", "w", heads, dim)


def gat_layer(edges: DataFrame, h: DataFrame, layer: GatLayer) -> DataFrame:
    """Attention-weighted sum per edge type, heads side by side, residual and bias, summed over edge types.

    Numerator and denominator of the softmax are summed in one aggregation.
    """
    width = layer.heads * layer.dim
    attended = _attended(edges, h, layer)
    in_dim = next(iter(layer.project.values())).shape[1]
    own = {e: (layer.residual.get(e, np.zeros((width, in_dim))), layer.bias[e]) for e in layer.project}
    stacked = _own_terms(h, own, width).unionByName(_as_node(attended, "m"))
    return sum_vectors(stacked, ["node_type", "node_id"], "h", width)


def rgcn_layer(edges: DataFrame, h: DataFrame, layer: RgcnLayer) -> DataFrame:
    """``W_0 h_v + b + sum over edge types of W_r (sum of in-neighbours)``."""
    names = _name(layer.relation)
    in_dim = layer.self_loop.shape[1]
    out_dim = layer.self_loop.shape[0]
    summed = reduce_neighbors(edges.where(is_etype(layer.relation)), h, in_dim, "sum")
    related = summed.select(*RELATION, dense({k: [(w, None)] for k, w in names.items()}, etype_name(), "m").alias("h"))
    own = h.select(
        "node_type", "node_id", dense({"all": [(layer.self_loop, layer.bias)]}, F.lit("all"), "h").alias("h")
    )
    return sum_vectors(own.unionByName(_as_node(related, "h")), ["node_type", "node_id"], "h", out_dim)


def norm_and_activate(h: DataFrame, norm: Norm | None, activation: str | None) -> DataFrame:
    vec = F.col("h")
    if norm is not None:
        vec = layer_norm(vec, *norm)
    if activation is not None:
        vec = activate(vec, activation)
    return h.select("node_type", "node_id", vec.alias("h"))


# --- whole models -------------------------------------------------------------------------


@dataclass
class GraphModel:
    """An encoder of one family and a classifier head for one node type."""

    kind: str
    inputs: dict[str, Linear]
    layers: list
    norms: list[Norm | None]
    target_type: str | None = None
    head: list[Linear] | None = None
    link: list[Linear] | None = None


# Per family: the layer, the activation between layers, and whether the last layer is normalised.
_FAMILIES = {
    "sage": (sage_layer, "relu", False),
    "gat": (gat_layer, "elu", False),
    "rgcn": (rgcn_layer, "relu", True),
}


def layer_step(kind: str, edges: DataFrame, h: DataFrame, layer, norm: Norm | None, last: bool) -> DataFrame:
    """One layer of a family with what stands between two layers, or after the last one."""
    apply, activation, norm_last = _FAMILIES[kind]
    out = apply(edges, h, layer)
    if not last:
        return norm_and_activate(out, norm, activation)
    return norm_and_activate(out, norm, None) if norm_last else out


def encode(model: GraphModel, edges: DataFrame, nodes: DataFrame, vec: str = "feature_vec") -> DataFrame:
    """Full-graph inference, layer by layer: ``node_type, node_id, h``.

    Each layer is written once, since the next one reads it for own states and for messages.
    """
    h = input_projection(nodes.where(F.col(vec).isNotNull()), model.inputs, vec)
    h = materialize(h, "input")
    for i, layer in enumerate(model.layers):
        last = i + 1 == len(model.layers)
        out = layer_step(model.kind, edges, h, layer, model.norms[i], last)
        h = out if last else materialize(out, f"state{i}")
    return h


def classify(h: DataFrame, head: list[Linear], target_type: str) -> DataFrame:
    """Class probabilities for the target type; an error if it has no state at all."""
    # Written once, so that the check does not run the encoder a second time.
    rows = materialize(h.where(F.col("node_type") == target_type), "head-input")
    if rows.isEmpty():
        raise ValueError(f"node type {target_type!r} has no output")
    return score_logits(
        rows.select("node_type", "node_id", dense({target_type: head}, "node_type", "h").alias("logits"))
    )


def score_logits(rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c != "logits"]
    return (
        rows.select(*kept, "logits", softmax("logits").alias("probabilities"))
        .withColumn("prediction", argmax("probabilities"))
        .withColumn("confidence", F.array_max("probabilities"))
        .drop("logits")
    )


def link_scores(edges: DataFrame, h: DataFrame, predictor: list[Linear]) -> DataFrame:
    """``MLP([h_src ; h_dst])`` per edge; edges whose ends have no state are left out.

    The first matrix is split into its two halves, which are applied once per node. An edge
    then only adds two short vectors.
    """
    (w, b), (w2, b2) = predictor
    half = w.shape[1] // 2
    left = h.select(
        F.col("node_type").alias("src_type"), F.col("node_id").alias("src"),
        dense({"all": [(w[:, :half], b)]}, F.lit("all"), "h").alias("l"),
    )
    right = h.select(
        F.col("node_type").alias("dst_type"), F.col("node_id").alias("dst"),
        dense({"all": [(w[:, half:], None)]}, F.lit("all"), "h").alias("r"),
    )
    out = F.array(*[F.lit(float(x)) for x in w2[0]])
    hidden = F.zip_with("l", "r", lambda a, c: F.greatest(a + c, F.lit(0.0)))
    score = F.aggregate(
        F.zip_with(hidden, out, lambda a, c: a * c), F.lit(float(b2[0])), lambda acc, x: acc + x
    )
    return (
        edges.join(left, ["src_type", "src"])
        .join(right, ["dst_type", "dst"])
        .select(*edges.columns, score.alias("score"))
    )


def build_model(
    config: TrainConfig, feature_dims: dict[str, int], edge_types: list[EdgeType], seed: int = 42
) -> GraphModel:
    """A freshly initialised model of the named family; a type without features gets the hidden size."""
    rng = np.random.default_rng(seed)
    hidden, layers = config.hidden_channels, config.num_layers
    edge_types = [EdgeType(*e) for e in edge_types]
    types = sorted({t for e in edge_types for t in (e.src_type, e.dst_type)} | set(feature_dims))
    inputs = {t: random_linear(rng, hidden, feature_dims.get(t, hidden)) for t in types}
    stack: list = []
    norms: list[Norm | None] = []
    for i in range(layers):
        last = i + 1 == layers
        if config.model_type == "sage":
            parts = {e: (random_linear(rng, hidden, hidden), random_linear(rng, hidden, hidden)) for e in edge_types}
            stack.append(
                SageLayer(
                    {e: p[0][0] for e, p in parts.items()},
                    {e: p[1][0] for e, p in parts.items()},
                    {e: p[0][1] for e, p in parts.items()},
                )
            )
            width = hidden
        elif config.model_type == "gat":
            heads = 1 if last else config.num_heads
            inner = hidden if i == 0 else hidden * config.num_heads
            width = heads * hidden
            project = {e: random_linear(rng, width, inner)[0] for e in edge_types}
            stack.append(
                GatLayer(
                    project,
                    {e: rng.normal(0, 0.1, (heads, hidden)) for e in edge_types},
                    {e: rng.normal(0, 0.1, (heads, hidden)) for e in edge_types},
                    {e: np.zeros(width) for e in edge_types},
                    {} if last else {e: random_linear(rng, width, inner)[0] for e in edge_types},
                )
            )
        elif config.model_type == "rgcn":
            bases = np.stack([random_linear(rng, hidden, hidden)[0] for _ in range(8)])
            mix = {e: rng.normal(0, 0.5, 8) for e in edge_types}
            loop, bias = random_linear(rng, hidden, hidden)
            stack.append(RgcnLayer.from_bases(mix, bases, loop, bias))
            width = hidden
        else:
            raise ValueError(f"unknown model type {config.model_type!r}; known: {sorted(_FAMILIES)}")
        norms.append((np.ones(width), np.zeros(width)))
    head = [random_linear(rng, hidden // 2, hidden), random_linear(rng, config.num_classes, hidden // 2)]
    return GraphModel(config.model_type, inputs, stack, norms, config.target_node_type, head)
