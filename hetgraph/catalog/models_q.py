"""Vectors, propagation, layers, heads, metrics, training rules."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from hetgraph.catalog.registry import entries, query, r4
from hetgraph.catalog.sql import oracle, r4 as q4, wbias, wmat
from hetgraph.catalog.tables_q import ETYPES, TYPES, vec_digest
from hetgraph.functions import vectors as V
from hetgraph.functions.weights import formula_bias, formula_linear, formula_matrix, weights_from_table, weights_to_table
from hetgraph.operators import ids as I
from hetgraph.operators import layers as L
from hetgraph.operators import metrics as M
from hetgraph.operators import propagate as PR
from hetgraph.operators import sampling as S
from hetgraph.operators import training as TR
from hetgraph.schema import TrainConfig

HID, OUT, HEADS = 8, 4, 2
SLOT = {e: i + 3 for i, e in enumerate(ETYPES)}
INPUTS = {"user": formula_linear(HID, 64, 1), "item": formula_linear(HID, 64, 2)}


def projected(t):
    """Closed-form 64 -> 8 projection of the features per node type."""
    return L.input_projection(t.graph()[0], INPUTS, "feature_vec")


# --- vectors ------------------------------------------------------------------------------


@query(
    "normalize_features",
    oracle(
        ["x"],
        f"""+n AS (SELECT node_type, node_id, sqrt(sum(v * v)) AS norm FROM x GROUP BY ALL)
        SELECT node_type, node_id, j AS dim, {q4('v / norm')} AS value FROM x JOIN n USING (node_type, node_id)""",
    ),
)
def _(t):
    rows = t.graph()[0].withColumn("v", V.l2_normalize("feature_vec"))
    return entries(rows, "v", "node_type", "node_id")


@query(
    "array_vector",
    oracle(["nodes"], f"SELECT node_type, node_id, len(feature_vec) AS dims, {q4('list_sum(feature_vec::DOUBLE[])')} AS vec_sum FROM nodes"),
)
def _(t):
    as_vector = t.graph()[0].withColumn("v", V.array_to_vector("feature_vec"))
    return vec_digest(as_vector.withColumn("feature_vec", V.vector_to_array("v")), "node_type", "node_id")


@query(
    "softmax_argmax",
    oracle(
        ["x"],
        f"""+m AS (SELECT node_type, node_id, max(v) AS top FROM x GROUP BY ALL),
        z AS (SELECT node_type, node_id, sum(exp(v - top)) AS total, max(exp(v - top)) AS best, min(j) FILTER (v = top) AS prediction
          FROM x JOIN m USING (node_type, node_id) GROUP BY ALL)
        SELECT node_type, node_id, prediction::INTEGER AS prediction, {q4('best / total')} AS confidence FROM z""",
    ),
)
def _(t):
    rows = L.score_logits(t.graph()[0].select("node_type", "node_id", F.col("feature_vec").alias("logits")))
    return rows.select("node_type", "node_id", "prediction", r4("confidence").alias("confidence"))


@query("input_projection", oracle(["h"], f"SELECT node_type, node_id, o AS dim, {q4('v')} AS value FROM h"))
def _(t):
    # The weights make a round trip through their table form.
    table = weights_to_table(t.spark, {(0, k, "input"): w for k, w in INPUTS.items()})
    inputs = {slot: w for (_, slot, _), w in weights_from_table(table).items()}
    return entries(L.input_projection(t.graph()[0], inputs, "feature_vec"), "h", "node_type", "node_id")


@query(
    "layer_norm",
    oracle(
        ["x"],
        f"""+s AS (SELECT node_type, node_id, avg(v) AS mean, var_pop(v) AS var FROM x GROUP BY ALL)
        SELECT node_type, node_id, j AS dim, {q4("(v - mean) / sqrt(var + 1e-5) * (1 + j / 64.0) + " + wbias('j'))} AS value
        FROM x JOIN s USING (node_type, node_id)""",
    ),
)
def _(t):
    normed = V.layer_norm("feature_vec", 1 + np.arange(64) / 64.0, formula_bias(64))
    return entries(t.graph()[0].withColumn("v", normed), "v", "node_type", "node_id")


@query(
    "activations",
    oracle(
        ["x"],
        f"""SELECT node_type, node_id, j AS dim, {q4('CASE WHEN v > 0 THEN v ELSE 0.0 END')} AS relu,
        {q4('CASE WHEN v > 0 THEN v ELSE exp(v) - 1 END')} AS elu,
        {q4('CASE WHEN v > 0 THEN v ELSE 0.2 * v END')} AS leaky_relu FROM x""",
    ),
)
def _(t):
    both = t.graph()[0].select(
        "node_type",
        "node_id",
        F.arrays_zip(*[V.activate("feature_vec", a).alias(a) for a in V.ACTIVATIONS]).alias("a"),
    )
    return both.select("node_type", "node_id", F.posexplode("a").alias("dim", "a")).select(
        "node_type", "node_id", F.col("dim").cast("long").alias("dim"), *[r4(f"a.{a}").alias(a) for a in V.ACTIVATIONS]
    )


# --- propagation --------------------------------------------------------------------------

_MEAN = """SELECT src_type, rel, dst_type, dst, j, avg(v) AS v, count(*) AS n FROM gx
  JOIN gedges ON node_type = src_type AND node_id = src GROUP BY ALL"""
_GX = """+gx AS (SELECT node_type, global_id AS node_id, unnest(range(64)) AS j, unnest(feature_vec)::DOUBLE AS v
  FROM nodes JOIN gid USING (node_type, node_id))"""


def global_graph(t):
    nodes, edges = t.graph()
    ids = I.assign_global_ids(nodes, TYPES)
    named = I.attach_global_id(nodes, ids).select("node_type", F.col("global_id").alias("node_id"), "feature_vec", "label")
    return named, I.rewrite_edges(edges, ids)


@query("neighbor_mean", oracle(["gedges"], f"{_GX} SELECT rel, dst, n, j AS dim, {q4('v')} AS value FROM ({_MEAN})"))
def _(t):
    nodes, edges = global_graph(t)
    return entries(PR.neighbor_mean(edges, PR.state_of(nodes), 64), "m", "rel", "dst", "n")


@query(
    "hetero_sum",
    oracle(
        ["gedges"],
        f"""{_GX} SELECT dst_type AS node_type, dst AS node_id, j AS dim, {q4('sum(v)')} AS value FROM ({_MEAN})
        GROUP BY dst_type, dst, j""",
    ),
)
def _(t):
    nodes, edges = global_graph(t)
    summed = PR.hetero_sum(PR.neighbor_mean(edges, PR.state_of(nodes), 64), 64)
    return entries(summed, "h", "node_type", "node_id")


@query(
    "neighbor_gcn",
    oracle(
        ["h", "edges"],
        f"""SELECT r.rel, own.node_id AS dst, coalesce(s.n, 0)::BIGINT AS n, own.o AS dim,
          {q4('(coalesce(s.v, 0) + own.v) / (coalesce(s.n, 0) + 1)')} AS value
        FROM (SELECT DISTINCT rel, dst_type FROM edges) r JOIN h own ON own.node_type = r.dst_type
        LEFT JOIN (SELECT rel, dst_type, dst, o, sum(v) AS v, count(*) AS n FROM h JOIN edges ON node_type = src_type AND node_id = src
          GROUP BY ALL) s ON s.rel = r.rel AND s.dst_type = r.dst_type AND s.dst = own.node_id AND s.o = own.o""",
    ),
)
def _(t):
    return entries(PR.neighbor_gcn(t.graph()[1], projected(t), HID), "m", "rel", "dst", "n")


@query(
    "neighbor_max",
    oracle(
        ["h", "edges"],
        f"""SELECT rel, dst, o AS dim, count(*) AS n, {q4('max(v)')} AS value FROM h JOIN edges
        ON node_type = src_type AND node_id = src GROUP BY rel, dst, o""",
    ),
)
def _(t):
    return entries(PR.neighbor_max(t.graph()[1], projected(t), HID), "m", "rel", "dst", "n")


# --- layers -------------------------------------------------------------------------------

SAGE = L.SageLayer(
    own={e: formula_matrix(OUT, HID, s + 10) for e, s in SLOT.items()},
    neighbor={e: formula_matrix(OUT, HID, s) for e, s in SLOT.items()},
    bias={e: formula_bias(OUT, s) for e, s in SLOT.items()},
)

_SAGE_SQL = f"""+m AS (SELECT e.dst_type, e.dst, et.slot, o, avg(v) AS v FROM edges e JOIN et USING (src_type, rel, dst_type)
    JOIN h ON node_type = e.src_type AND node_id = e.src GROUP BY ALL),
  parts AS (
    SELECT dst_type AS node_type, dst AS node_id, p, sum(v * {wmat('p', 'o', 'slot')}) AS v FROM m, range({OUT}) t(p) GROUP BY ALL
    UNION ALL SELECT h.node_type, h.node_id, p, sum(v * {wmat('p', 'o', 'slot + 10')}) FROM h JOIN et ON et.dst_type = h.node_type,
      range({OUT}) t(p) GROUP BY h.node_type, h.node_id, p
    UNION ALL SELECT h.node_type, h.node_id, p, sum({wbias('p', 'slot')}) FROM (SELECT DISTINCT node_type, node_id FROM h) h
      JOIN et ON et.dst_type = h.node_type, range({OUT}) t(p) GROUP BY h.node_type, h.node_id, p
    UNION ALL SELECT node_type, node_id, p, 0.0 FROM (SELECT DISTINCT node_type, node_id FROM h), range({OUT}) t(p)),
  out AS (SELECT node_type, node_id, p AS dim, sum(v) AS v FROM parts GROUP BY ALL)"""


def sage_out(t):
    return L.sage_layer(t.graph()[1], projected(t), SAGE)


@query("sage_layer", oracle(["h", "edges", "et"], f"{_SAGE_SQL} SELECT node_type, node_id, dim, {q4('v')} AS value FROM out"))
def _(t):
    return entries(sage_out(t), "h", "node_type", "node_id")


ENCODER = L.GraphModel(
    "sage",
    INPUTS,
    [
        L.SageLayer(
            own={e: formula_matrix(HID, HID, s + 110) for e, s in SLOT.items()},
            neighbor={e: formula_matrix(HID, HID, s + 100) for e, s in SLOT.items()},
            bias={e: formula_bias(HID, s + 100) for e, s in SLOT.items()},
        ),
        SAGE,
    ],
    [(1 + np.arange(HID) / 8.0, formula_bias(HID, 120)), None],
)


def _sage_sql(h: str, out: str, width: int, own: int, neighbor: int) -> str:
    """One layer over a state ``h(node_type, node_id, o, v)``, giving ``out`` of the same shape."""
    return f"""{out}_m AS (SELECT e.dst_type, e.dst, et.slot, o, avg(v) AS v FROM edges e JOIN et USING (src_type, rel, dst_type)
    JOIN {h} ON node_type = e.src_type AND node_id = e.src GROUP BY ALL),
  {out}_n AS (SELECT DISTINCT node_type, node_id FROM {h}),
  {out}_p AS (
    SELECT dst_type AS node_type, dst AS node_id, p, sum(v * {wmat('p', 'o', f'slot + {neighbor}')}) AS v
      FROM {out}_m, range({width}) t(p) GROUP BY dst_type, dst, p
    UNION ALL SELECT s.node_type, s.node_id, p, sum(v * {wmat('p', 'o', f'slot + {own}')}) FROM {h} s
      JOIN et ON et.dst_type = s.node_type, range({width}) t(p) GROUP BY s.node_type, s.node_id, p
    UNION ALL SELECT n.node_type, n.node_id, p, sum({wbias('p', f'slot + {neighbor}')}) FROM {out}_n n
      JOIN et ON et.dst_type = n.node_type, range({width}) t(p) GROUP BY n.node_type, n.node_id, p
    UNION ALL SELECT node_type, node_id, p, 0.0 FROM {out}_n, range({width}) t(p)),
  {out} AS (SELECT node_type, node_id, p AS o, sum(v) AS v FROM {out}_p GROUP BY node_type, node_id, p)"""


@query(
    "sage_encoder",
    oracle(
        ["h", "edges", "et"],
        f"""+{_sage_sql('h', 'one', HID, 110, 100)},
        spread AS (SELECT node_type, node_id, avg(v) AS mean, var_pop(v) AS var FROM one GROUP BY node_type, node_id),
        mid AS (SELECT node_type, node_id, o,
            greatest((v - mean) / sqrt(var + 1e-5) * (1 + o / 8.0) + {wbias('o', '120')}, 0) AS v
          FROM one JOIN spread USING (node_type, node_id)),
        {_sage_sql('mid', 'two', OUT, 10, 0)}
        SELECT node_type, node_id, o AS dim, {q4('v')} AS value FROM two""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    return entries(L.encode(ENCODER, edges, nodes), "h", "node_type", "node_id")


GAT = L.GatLayer(
    project={e: formula_matrix(HEADS * OUT, HID, s) for e, s in SLOT.items()},
    attn_src={e: formula_matrix(HEADS, OUT, s + 20) for e, s in SLOT.items()},
    attn_dst={e: formula_matrix(HEADS, OUT, s + 30) for e, s in SLOT.items()},
    bias={e: formula_bias(HEADS * OUT, s) for e, s in SLOT.items()},
    residual={e: formula_matrix(HEADS * OUT, HID, s + 10) for e, s in SLOT.items()},
)

_ATTN_SQL = f"""+q AS (SELECT et.*, node_type, node_id, r, sum(v * {wmat('r', 'o', 'slot')}) AS v
    FROM h JOIN et ON node_type IN (et.src_type, et.dst_type), range({HEADS * OUT}) t(r) GROUP BY ALL),
  sc AS (SELECT slot, src_type, rel, dst_type, node_type, node_id, r // {OUT} AS head,
      sum(v * {wmat(f'r // {OUT}', f'r % {OUT}', 'slot + 20')}) AS s,
      sum(v * {wmat(f'r // {OUT}', f'r % {OUT}', 'slot + 30')}) AS d FROM q GROUP BY ALL),
  raw AS (SELECT e.src_type, e.rel, e.dst_type, e.src, e.dst, a.slot, a.head,
      CASE WHEN a.s + b.d > 0 THEN a.s + b.d ELSE 0.2 * (a.s + b.d) END AS e
    FROM edges e JOIN sc a ON a.src_type = e.src_type AND a.rel = e.rel AND a.dst_type = e.dst_type
        AND a.node_type = e.src_type AND a.node_id = e.src
      JOIN sc b ON b.slot = a.slot AND b.head = a.head AND b.node_type = e.dst_type AND b.node_id = e.dst),
  alpha AS (SELECT *, exp(e - max(e) OVER w) / sum(exp(e)) OVER w * exp(max(e) OVER w) AS alpha
    FROM raw WINDOW w AS (PARTITION BY slot, dst, head))"""


@query(
    "attention_weights",
    oracle(
        ["h", "edges", "et"],
        f"{_ATTN_SQL} SELECT rel, src, dst, head::BIGINT AS dim, {q4('alpha')} AS value FROM alpha",
    ),
)
def _(t):
    return entries(L.attention_weights(t.graph()[1], projected(t), GAT), "alpha", "rel", "src", "dst")


@query(
    "gat_layer",
    oracle(
        ["h", "edges", "et"],
        f"""{_ATTN_SQL}, parts AS (
          SELECT a.dst_type AS node_type, a.dst AS node_id, r AS dim, sum(a.alpha * q.v) AS v FROM alpha a
            JOIN q ON q.slot = a.slot AND q.node_type = a.src_type AND q.node_id = a.src AND q.r // {OUT} = a.head
            GROUP BY a.dst_type, a.dst, r
          UNION ALL SELECT h.node_type, h.node_id, r, sum(v * {wmat('r', 'o', 'slot + 10')}) FROM h
            JOIN et ON et.dst_type = h.node_type, range({HEADS * OUT}) t(r) GROUP BY h.node_type, h.node_id, r
          UNION ALL SELECT n.node_type, n.node_id, r, sum({wbias('r', 'slot')}) FROM (SELECT DISTINCT node_type, node_id FROM h) n
            JOIN et ON et.dst_type = n.node_type, range({HEADS * OUT}) t(r) GROUP BY n.node_type, n.node_id, r
          UNION ALL SELECT node_type, node_id, r, 0.0 FROM (SELECT DISTINCT node_type, node_id FROM h), range({HEADS * OUT}) t(r))
        SELECT node_type, node_id, dim, {q4('sum(v)')} AS value FROM parts GROUP BY node_type, node_id, dim""",
    ),
)
def _(t):
    return entries(L.gat_layer(t.graph()[1], projected(t), GAT), "h", "node_type", "node_id")


BASES = np.stack([formula_matrix(OUT, HID, 40 + b) for b in range(2)])
MIX = {e: np.array([1.0 / s, 0.5]) for e, s in SLOT.items()}
RGCN = L.RgcnLayer.from_bases(MIX, BASES, formula_matrix(OUT, HID, 50), formula_bias(OUT, 50))


@query(
    "rgcn_layer",
    oracle(
        ["h", "edges", "et"],
        f"""+m AS (SELECT e.dst_type, e.dst, et.slot, o, sum(v) AS v FROM edges e JOIN et USING (src_type, rel, dst_type)
            JOIN h ON node_type = e.src_type AND node_id = e.src GROUP BY ALL),
        parts AS (SELECT dst_type AS node_type, dst AS node_id, p,
            sum(v * ({wmat('p', 'o', '40')} / slot + {wmat('p', 'o', '41')} * 0.5)) AS v FROM m, range({OUT}) t(p) GROUP BY ALL
          UNION ALL SELECT node_type, node_id, p, sum(v * {wmat('p', 'o', '50')}) + {wbias('p', '50')} FROM h, range({OUT}) t(p)
            GROUP BY node_type, node_id, p)
        SELECT node_type, node_id, p AS dim, {q4('sum(v)')} AS value FROM parts GROUP BY node_type, node_id, p""",
    ),
)
def _(t):
    return entries(L.rgcn_layer(t.graph()[1], projected(t), RGCN), "h", "node_type", "node_id")


HEAD = [formula_linear(6, OUT, 60), formula_linear(10, 6, 61)]


def _mlp_sql(source: str, keys: str, width: int, slots=(60, 61), dims=(6, 10)) -> str:
    """``hid`` and ``logit`` of a two-layer network on ``source(keys, j, v)``."""
    return f"""hid AS (SELECT {keys}, p, greatest(sum(v * {wmat('p', 'j', str(slots[0]))}) + {wbias('p', str(slots[0]))}, 0) AS v
      FROM {source}, range({dims[0]}) t(p) GROUP BY {keys}, p),
    logit AS (SELECT {keys}, c, sum(v * {wmat('c', 'p', str(slots[1]))}) + {wbias('c', str(slots[1]))} AS v
      FROM hid, range({dims[1]}) t(c) GROUP BY {keys}, c),
    top AS (SELECT {keys}, max(v) AS top FROM logit GROUP BY ALL),
    scored AS (SELECT {keys}, (min(c) FILTER (v = top))::INTEGER AS prediction,
      1 / sum(exp(v - top)) AS confidence FROM logit JOIN top USING ({keys}) GROUP BY ALL)"""


@query(
    "classify_nodes",
    oracle(
        ["h", "edges", "et"],
        f"""{_SAGE_SQL}, src AS (SELECT node_id, dim AS j, v FROM out WHERE node_type = 'item'), {_mlp_sql('src', 'node_id', OUT)}
        SELECT 'item' AS node_type, node_id, prediction, {q4('confidence')} AS confidence FROM scored""",
    ),
)
def _(t):
    rows = L.classify(sage_out(t), HEAD, "item")
    return rows.select("node_type", "node_id", "prediction", r4("confidence").alias("confidence"))


LINK = [formula_linear(6, 2 * HID, 62), formula_linear(1, 6, 63)]


@query(
    "link_scores",
    oracle(
        ["h", "edges"],
        f"""+lr AS (SELECT node_type, node_id, p, sum(v * {wmat('p', 'o', '62')}) AS l, sum(v * {wmat('p', f'o + {HID}', '62')}) AS r
            FROM h, range(6) t(p) GROUP BY ALL),
        pairs AS (SELECT row_number() OVER () AS place, src_type, rel, dst_type, src, dst FROM edges)
        SELECT e.src_type, e.rel, e.dst_type, e.src, e.dst,
          {q4(f"sum(greatest(a.l + b.r + {wbias('a.p', '62')}, 0) * {wmat('0', 'a.p', '63')}) + {wbias('0', '63')}")} AS score
        FROM pairs e JOIN lr a ON a.node_type = e.src_type AND a.node_id = e.src
        JOIN lr b ON b.node_type = e.dst_type AND b.node_id = e.dst AND b.p = a.p
        GROUP BY e.place, e.src_type, e.rel, e.dst_type, e.src, e.dst""",
    ),
)
def _(t):
    pairs = t.graph()[1].drop("edge_weight")
    scores = L.link_scores(pairs, projected(t), LINK)
    return scores.withColumn("score", r4("score"))


MLP = [formula_linear(16, 64, 64), formula_linear(10, 16, 65)]


@query(
    "mlp_classifier",
    oracle(
        ["x"],
        f"""+{_mlp_sql('x', 'node_type, node_id', 64, (64, 65), (16, 10))}
        SELECT node_type, node_id, prediction, {q4('confidence')} AS confidence FROM scored""",
    ),
)
def _(t):
    rows = TR.mlp_logits(t.graph()[0].select("node_type", "node_id", "feature_vec"), MLP)
    return rows.select("node_type", "node_id", "prediction", r4("confidence").alias("confidence"))


# --- metrics ------------------------------------------------------------------------------


def paired_labels(t):
    """Purchases as predictions: the label of the buyer against that of the item."""
    users = t.nodes_user().select(F.col("node_id").alias("src"), F.col("label").alias("prediction"))
    items = t.nodes_item().select(F.col("node_id").alias("dst"), "label")
    e = t.graph()[1].where(F.col("rel") == "purchase").select("src", "dst")
    return e.join(users, "src").join(items, "dst").select("src", "label", "prediction")


_PAIRS = """pairs AS (SELECT src, i.label AS label, u.label AS prediction FROM edges_purchase
  JOIN nodes_user u ON u.node_id = src JOIN nodes_item i ON i.node_id = dst)"""


def _metrics_sql(pairs: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    using = f"USING ({b}cls)"
    group = f"GROUP BY {by}" if by else ""
    return f"""cls AS (SELECT DISTINCT {b}label AS cls FROM {pairs} UNION SELECT DISTINCT {b}prediction FROM {pairs}),
  t AS (SELECT {b}label AS cls, count(*) AS n FROM {pairs} GROUP BY ALL),
  p AS (SELECT {b}prediction AS cls, count(*) AS n FROM {pairs} GROUP BY ALL),
  hit AS (SELECT {b}label AS cls, count(*) AS n FROM {pairs} WHERE label = prediction GROUP BY ALL),
  c AS (SELECT {b}cls, coalesce(t.n, 0) AS tr, coalesce(p.n, 0) AS pr, coalesce(hit.n, 0) AS ok
    FROM cls LEFT JOIN t {using} LEFT JOIN p {using} LEFT JOIN hit {using})
  SELECT {b}{q4('sum(ok) / sum(tr)')} AS accuracy,
    {q4('avg(CASE WHEN pr > 0 THEN ok / pr ELSE 0 END)')} AS precision,
    {q4('avg(CASE WHEN tr > 0 THEN ok / tr ELSE 0 END)')} AS recall,
    {q4('avg(CASE WHEN tr + pr > 0 THEN 2 * ok / (tr + pr) ELSE 0 END)')} AS f1,
    count(*) AS num_classes, sum(tr)::BIGINT AS num_rows FROM c {group}"""


def rounded_metrics(df, *by):
    return df.select(*by, *[r4(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "num_classes", "num_rows")


@query(
    "confusion_matrix",
    oracle(
        ["edges_purchase", "nodes_user", "nodes_item"],
        f"+{_PAIRS} SELECT label, prediction, count(*) AS rows FROM pairs GROUP BY ALL",
    ),
)
def _(t):
    return M.confusion_matrix(paired_labels(t))


@query(
    "classification_metrics",
    oracle(["edges_purchase", "nodes_user", "nodes_item"], f"+{_PAIRS}, {_metrics_sql('pairs')}"),
)
def _(t):
    return rounded_metrics(M.classification_metrics(paired_labels(t)))


@query(
    "evaluate_split",
    oracle(
        ["masks", "edges_purchase", "nodes_user", "nodes_item"],
        f"""+{_PAIRS}, sp AS (SELECT CASE WHEN train_mask THEN 'train' WHEN val_mask THEN 'val' ELSE 'test' END AS split,
          pairs.label AS label, prediction FROM pairs JOIN masks ON masks.node_type = 'user' AND masks.node_id = src),
        {_metrics_sql('sp', 'split')}""",
    ),
)
def _(t):
    rows = paired_labels(t).select(F.lit("user").alias("node_type"), F.col("src").alias("node_id"), "label", "prediction")
    return rounded_metrics(TR.evaluate(S.split_masks(rows)), "split")


@query(
    "sync_metric",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) / sum(l_linenumber) AS metric FROM lineitem GROUP BY ALL""",
)
def _(t):
    return M.sync_metric(t.raw("lineitem"), "l_quantity", "l_linenumber", by=("l_returnflag", "l_linestatus"))


@query(
    "array_reduce",
    " UNION ALL ".join(
        f"""SELECT '{op}' AS op, label, j AS dim, {q4(f'{f}(v)')} AS value FROM (
        SELECT label, unnest(range(64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY label, j"""
        for op, f in (("sum", "sum"), ("mean", "avg"), ("max", "max"), ("min", "min"))
    ),
)
def _(t):
    out = None
    for op in ("sum", "mean", "max", "min"):
        rows = t.raw("embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
        part = entries(M.reduce_arrays(rows, ["label"], "v", 64, op).withColumn("op", F.lit(op)), "v", "op", "label")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "array_reduce_long",
    f"""SELECT label, j AS dim, {q4('avg(v)')} AS value FROM (
        SELECT label, unnest(range(128)) AS j, unnest(list_concat(embedding, embedding))::DOUBLE AS v FROM embeddings) GROUP BY label, j""",
)
def _(t):
    rows = t.raw("embeddings").withColumn("v", F.concat("embedding", "embedding").cast("array<double>"))
    return entries(M.reduce_arrays(rows, ["label"], "v", 128, "mean"), "v", "label")


@query(
    "epoch_metrics",
    """SELECT l_suppkey AS run_id, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS epoch,
    sum(l_discount::DECIMAL(9, 2) * l_quantity::DECIMAL(9, 0))::DOUBLE / sum(l_quantity)::DOUBLE AS loss,
    sum(l_linenumber)::DOUBLE / sum(l_quantity)::DOUBLE AS accuracy FROM lineitem GROUP BY ALL""",
)
def _(t):
    batches = t.raw("lineitem").select(
        F.col("l_suppkey").alias("run_id"),
        ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("long").alias("epoch"),
        F.col("l_discount").cast("decimal(9,2)").alias("loss"),
        F.col("l_linenumber").alias("correct"),
        F.col("l_quantity").cast("decimal(9,0)").alias("size"),
    )
    return M.epoch_metrics(batches)


def runs(t):
    """A validation score per supplier and month: runs grow with the data, epochs do not."""
    months = t.raw("lineitem").select(
        F.col("l_suppkey").alias("run_id"),
        ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("long").alias("epoch"),
        F.col("l_discount").cast("decimal(18,4)").alias("d"),
    )
    return months.groupBy("run_id", "epoch").agg(
        (F.sum("d").cast("double") / F.count(F.lit(1)).cast("double")).alias("score")
    )


@query(
    "best_epoch",
    oracle(
        ["runs"],
        """SELECT run_id, epoch AS best_epoch, score AS best_score FROM (
          SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY score DESC, epoch) AS k FROM runs) WHERE k = 1""",
    ),
)
def _(t):
    return TR.best_epoch(runs(t))


def _fold_sql(columns: str, first: str, step: str, last: str) -> str:
    """Walk all runs epoch by epoch."""
    return f"""+o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS i FROM runs),
  f({columns}) AS (SELECT {first} FROM o WHERE i = 1
    UNION ALL SELECT {step} FROM f JOIN o ON o.run_id = f.run_id AND o.i = f.i + 1)
  {last}"""


@query(
    "early_stop",
    oracle(
        ["runs"],
        _fold_sql(
            "run_id, i, best, misses, stop",
            "run_id, i, score, 0, NULL::BIGINT",
            """o.run_id, o.i, CASE WHEN stop IS NULL AND score > best + 0.001 THEN score ELSE best END,
            CASE WHEN stop IS NOT NULL THEN misses WHEN score > best + 0.001 THEN 0 ELSE misses + 1 END,
            CASE WHEN stop IS NOT NULL THEN stop WHEN score <= best + 0.001 AND misses + 1 >= 15 THEN o.epoch END""",
            "SELECT run_id, arg_max(stop, i) AS stop_epoch, arg_max(best, i) AS best_score FROM f GROUP BY run_id",
        ),
        recursive=True,
    ),
)
def _(t):
    return TR.early_stop(runs(t), patience=15, min_delta=0.001)


@query(
    "lr_schedule",
    oracle(
        ["runs"],
        _fold_sql(
            "run_id, i, epoch, best, misses, lr",
            "run_id, i, epoch, score, 0, 0.001::DOUBLE",
            """o.run_id, o.i, o.epoch, CASE WHEN score > best * 1.0001 THEN score ELSE best END,
            CASE WHEN score > best * 1.0001 OR misses + 1 > 5 THEN 0 ELSE misses + 1 END,
            CASE WHEN score <= best * 1.0001 AND misses + 1 > 5 THEN lr * 0.5 ELSE lr END""",
            "SELECT run_id, epoch, lr FROM f",
        ),
        recursive=True,
    ),
)
def _(t):
    return TR.lr_schedule(runs(t))


@query(
    "propagated_features",
    oracle(
        ["h", "edges"],
        f"""+m AS (SELECT rel, src_type, dst_type, dst, o, avg(v) AS v FROM h JOIN edges ON node_type = src_type AND node_id = src GROUP BY ALL),
        p AS (SELECT dst_type, dst, o, avg(v) AS v FROM m GROUP BY ALL)
        SELECT node_type, node_id, o AS dim, {q4('v')} AS value FROM h
        UNION ALL SELECT h.node_type, h.node_id, h.o + {HID}, {q4('coalesce(p.v, 0)')} FROM h
        LEFT JOIN p ON p.dst_type = h.node_type AND p.dst = h.node_id AND p.o = h.o""",
    ),
)
def _(t):
    nodes = projected(t).withColumnRenamed("h", "feature_vec")
    return entries(PR.propagated_features(nodes, t.graph()[1], HID, 1), "features", "node_type", "node_id")


@query("fit_propagated")
def _(t):
    nodes, edges = t.graph()
    config = TrainConfig(target_node_type="item")
    data = TR.graph_features(nodes, edges, 64, 1, config)
    model = TR.fit_classifier(data.where("train_mask"))
    return rounded_metrics(TR.evaluate(TR.predict(model, data)), "split")
