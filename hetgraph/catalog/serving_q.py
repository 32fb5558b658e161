"""Feature store, request parsing, scoring, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hetgraph.catalog.models_q import HEAD, HID, INPUTS, MLP, OUT, _mlp_sql
from hetgraph.catalog.registry import query, r4
from hetgraph.catalog.sampling_q import _one_layer
from hetgraph.catalog.sql import oracle, r4 as q4, wbias, wmat
from hetgraph.functions.weights import formula_bias, formula_matrix
from hetgraph.operators import features as FE
from hetgraph.operators import serving as SV
from hetgraph.operators.layers import SageLayer
from hetgraph.runtime import checkpoint_root
from hetgraph.schema import EdgeType
from hetgraph.streaming import feature_log, feature_state, scoring
from hetgraph.catalog.tables_q import ETYPES

NOW = "2024-01-30 00:00:00"


def scratch(t, label: str) -> str:
    return f"{checkpoint_root(t.spark)}/hetgraph/{label}-{uuid.uuid4().hex}"


def write_log(events):
    """Every event as a write of its user's value; an error event deletes it."""
    return events.select(
        F.lit("user").alias("node_type"),
        F.col("user_id").alias("node_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("props").alias("value"),
        (F.col("event_type") == "error").alias("deleted"),
    )


_LATEST = """SELECT 'user' AS node_type, user_id AS node_id, arg_max(props, (ts, event_id)) AS value, max(ts) AS ts,
  arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS kind
  FROM events WHERE ts <= TIMESTAMP '2024-01-30 00:00:00' GROUP BY user_id"""


def _latest_sql(keep: str) -> str:
    return f"""SELECT node_type, node_id, value, event_id FROM ({_LATEST})
    WHERE ts > TIMESTAMP '2024-01-29 00:00:00' AND {keep}"""


def _state(log):
    return FE.latest_features(log, NOW).select("node_type", "node_id", "value", "event_id")


@query("feature_latest_ttl", _latest_sql("true"))
def _(t):
    return _state(write_log(t.raw("events")).drop("deleted"))


@query("feature_delete", _latest_sql("kind <> 'error'"))
def _(t):
    return _state(write_log(t.raw("events")))


@query(
    "feature_stats",
    """SELECT 'user' AS node_type, count(*) AS num_keys, sum(length(value))::BIGINT AS value_chars FROM (
    SELECT arg_max(props, (ts, event_id)) AS value FROM events GROUP BY user_id)""",
)
def _(t):
    ever = FE.latest_features(write_log(t.raw("events")).drop("deleted"), "2100-01-01 00:00:00", ttl=10**10)
    return FE.feature_stats(ever.select(FE.feature_key().alias("key"), "value"))


def stream_of(t, name: str):
    return t.spark.readStream.schema(t.raw(name).schema).option("pathGlobFilter", f"{name}.parquet").parquet(t.sf_dir)


@query("feature_stream", _latest_sql("kind <> 'error'"))
def _(t):
    path = scratch(t, "log")
    feature_log.append_log(write_log(stream_of(t, "events")), path, scratch(t, "log-state")).awaitTermination()
    return _state(feature_log.compact_log(feature_log.read_log(t.spark, path), scratch(t, "compact"), NOW))


@query(
    "feature_state",
    """SELECT node_type, node_id, value, event_id FROM (SELECT 'user' AS node_type, user_id AS node_id,
      arg_max(props, (ts, event_id)) AS value, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id,
      arg_max(event_type, (ts, event_id)) AS kind FROM events GROUP BY user_id)
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY AND kind <> 'error'""",
)
def _(t):
    state = scratch(t, "state")
    feature_state.keep_state(write_log(stream_of(t, "events")), scratch(t, "changes"), state).awaitTermination()
    return feature_state.read_state(t.spark, state).select("node_type", "node_id", "value", "event_id")


# --- requests -----------------------------------------------------------------------------


def bodies(events):
    """Every event as a request body, with the fields that clients leave out or get wrong."""
    kind = F.col("event_type")
    is_item = kind == "view"
    fields = F.struct(
        F.when(kind != "error", F.when(is_item, F.get_json_object("props", "$.k").cast("long") * 30).otherwise(F.col("user_id"))).alias("node_id"),
        F.when(is_item, F.lit("item")).alias("node_type"),
        F.when(kind == "purchase", F.lit("graph_classify")).when(kind == "signup", F.lit("link_predict")).alias("task_type"),
    )
    return events.select("event_id", F.to_json(fields).alias("body"))


_PARSED = """SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 30
    WHEN event_type <> 'error' THEN user_id END AS node_id,
  CASE WHEN event_type = 'view' THEN 'item' ELSE 'user' END AS node_type,
  CASE event_type WHEN 'purchase' THEN 'graph_classify' WHEN 'signup' THEN 'link_predict' ELSE 'node_classify' END AS task_type,
  CASE event_type WHEN 'error' THEN 'missing node_id' WHEN 'purchase' THEN 'unknown task type: graph_classify' END AS error
  FROM events"""


@query("parse_requests", _PARSED)
def _(t):
    return SV.parse_requests(bodies(t.raw("events")))


REV = [e.reverse() for e in ETYPES]
REQUEST_LAYER = SageLayer(
    own={e: formula_matrix(OUT, HID, 80 + i) for i, e in enumerate(REV)},
    neighbor={e: formula_matrix(OUT, HID, 70 + i) for i, e in enumerate(REV)},
    bias={e: formula_bias(OUT, 70 + i) for i, e in enumerate(REV)},
)

_SCORE_SQL = f"""+parsed AS ({_PARSED}),
  f0 AS (SELECT DISTINCT node_type, node_id, 0 AS layer FROM parsed WHERE error IS NULL AND task_type = 'node_classify'),
  b AS ({_one_layer('out', 'f0', '', ['layer'], 3)}),
  ids AS (SELECT node_type, node_id FROM f0 UNION SELECT far_type, far FROM b),
  hx AS (SELECT ids.node_type, ids.node_id, t.o,
      coalesce(h.v, {wbias('t.o', "CASE ids.node_type WHEN 'user' THEN 1 ELSE 2 END")}) AS v
    FROM ids CROSS JOIN range({HID}) t(o) LEFT JOIN h ON h.node_type = ids.node_type AND h.node_id = ids.node_id AND h.o = t.o),
  ret AS (SELECT * FROM (VALUES ('user', 'click', 0), ('user', 'purchase', 1), ('item', 'similar', 2)) r(node_type, rel, slot)),
  m AS (SELECT b.node_type, b.node_id, slot, o, avg(v) AS v FROM b JOIN ret ON ret.rel = b.rel
    JOIN hx ON hx.node_type = b.far_type AND hx.node_id = b.far GROUP BY ALL),
  parts AS (SELECT node_type, node_id, p, sum(v * {wmat('p', 'o', 'slot + 70')}) AS v FROM m, range({OUT}) t(p) GROUP BY ALL
    UNION ALL SELECT hx.node_type, hx.node_id, p, sum(v * {wmat('p', 'o', 'slot + 80')}) FROM hx JOIN ret ON ret.node_type = hx.node_type,
      range({OUT}) t(p) GROUP BY hx.node_type, hx.node_id, p
    UNION ALL SELECT f0.node_type, f0.node_id, p, sum({wbias('p', 'slot + 70')}) FROM f0 JOIN ret ON ret.node_type = f0.node_type,
      range({OUT}) t(p) GROUP BY f0.node_type, f0.node_id, p),
  src AS (SELECT node_type, node_id, p AS j, sum(v) AS v FROM parts JOIN (SELECT node_type, node_id FROM f0) USING (node_type, node_id)
    GROUP BY ALL),
  {_mlp_sql('src', 'node_type, node_id', OUT)}
  SELECT event_id, p.node_id, p.node_type, p.task_type, CASE WHEN e IS NULL THEN prediction END AS prediction,
    CASE WHEN e IS NULL THEN {q4('confidence')} END AS confidence, e AS error
  FROM (SELECT *, coalesce(error, CASE WHEN task_type <> 'node_classify' THEN 'needs link_scores' END) AS e FROM parsed) p
  LEFT JOIN scored s ON s.node_type = p.node_type AND s.node_id = p.node_id"""


@query("batch_score", oracle(["h", "heads_out"], _SCORE_SQL))
def _(t):
    nodes, edges = t.graph()
    answers = SV.batch_score(
        bodies(t.raw("events")),
        "body",
        features=nodes,
        edges=edges,
        inputs=INPUTS,
        layers=[REQUEST_LAYER],
        head=HEAD,
        fanouts=[3],
        default_dim=64,
    )
    return answers.drop("probabilities").withColumn("confidence", r4("confidence"))


_JSON_SQL = f"""+{_mlp_sql('x', 'node_type, node_id', 64, (64, 65), (16, 10))},
  parsed AS (SELECT * REPLACE (coalesce(error, CASE WHEN task_type <> 'node_classify' THEN 'needs link_scores' END) AS error)
    FROM ({_PARSED}))
  SELECT event_id, p.node_id, p.node_type, CASE WHEN error IS NULL THEN coalesce(s.prediction, zero.prediction) END AS prediction,
    CASE WHEN error IS NULL THEN {q4('coalesce(s.confidence, zero.confidence)')} END AS confidence, error
  FROM parsed p LEFT JOIN scored s ON s.node_type = p.node_type AND s.node_id = p.node_id,
  (WITH hz AS (SELECT p, greatest({wbias('p', '64')}, 0) AS v FROM range(16) t(p)),
    lz AS (SELECT c, sum(v * {wmat('c', 'p', '65')}) + {wbias('c', '65')} AS v FROM hz, range(10) t(c) GROUP BY c)
    SELECT arg_max(c, v)::INTEGER AS prediction, 1 / sum(exp(v - (SELECT max(v) FROM lz))) AS confidence FROM lz) zero"""


def _read_back(responses):
    """The JSON answers as columns again."""
    back = F.from_json("response", "prediction int, confidence double, probabilities array<double>, node_id long, node_type string, error string")
    return responses.withColumn("r", back).select(
        "event_id", "r.node_id", "r.node_type", "r.prediction", r4("r.confidence").alias("confidence"), "r.error"
    )


@query("score_json", oracle(["x"], _JSON_SQL))
def _(t):
    return _read_back(scoring.score_requests(bodies(t.raw("events")), t.graph()[0], MLP))


@query("score_stream", oracle(["x"], _JSON_SQL))
def _(t):
    path = scratch(t, "responses")
    requests = bodies(stream_of(t, "events"))
    scoring.score_stream(requests, t.graph()[0], MLP, path, scratch(t, "responses-state")).awaitTermination()
    return _read_back(t.spark.read.schema("event_id long, response string").parquet(path))
