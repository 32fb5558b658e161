"""Request parsing and batch scoring of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.functions.vectors import Linear, dense
from hetgraph.operators.layers import Norm, layer_step, score_logits
from hetgraph.operators.sampling import neighbor_blocks
from hetgraph.operators.structure import Adjacency
from hetgraph.runtime import materialize
from hetgraph.schema import REQUEST_SCHEMA

DEFAULT_TYPE = "user"
CLASSIFY = "node_classify"
LINK = "link_predict"


def parse_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """JSON bodies (text or bytes) as ``node_id, node_type, task_type, error``.

    Defaults are filled in and the task is that of the row itself. A body without a node id,
    or one that is no JSON at all, becomes an error row.
    """
    parsed = requests.withColumn("__r", F.from_json(F.col(body).cast("string"), REQUEST_SCHEMA))
    node_id = F.col("__r.node_id")
    task = F.coalesce("__r.task_type", F.lit(CLASSIFY))
    error = F.when(node_id.isNull(), F.lit("missing node_id")).when(
        ~task.isin(CLASSIFY, LINK), F.concat(F.lit("unknown task type: "), task)
    )
    return parsed.select(
        *[c for c in requests.columns if c != body],
        node_id.alias("node_id"),
        F.coalesce("__r.node_type", F.lit(DEFAULT_TYPE)).alias("node_type"),
        task.alias("task_type"),
        error.alias("error"),
    )


def route_partition(node_id: str | Column, n: int) -> Column:
    """Partition that answers for a node."""
    return F.pmod(F.col(node_id) if isinstance(node_id, str) else node_id, F.lit(n)).cast("int")


def score_seeds(
    seeds: DataFrame,
    features: DataFrame,
    edges: DataFrame | Adjacency,
    inputs: dict[str, Linear],
    layers: list,
    head: list[Linear],
    fanouts: list[int | None],
    seed: int = 42,
    direction: str = "out",
    default_dim: int | None = None,
    kind: str = "sage",
    norms: list[Norm | None] | None = None,
) -> DataFrame:
    """Class probabilities of seed nodes from their sampled neighbourhood.

    The neighbourhood is sampled once per layer for all seeds together. Requests follow
    out-edges, so by default messages run against the edges; the layers must then be keyed by
    the types as seen from the seed (reversed edge types). ``kind`` and ``norms`` are those of the
    ``GraphModel``: between layers a seed's state goes the same way as in ``encode``.
    """
    blocks = materialize(neighbor_blocks(seeds, edges, fanouts, seed, direction), "blocks")
    needed = seeds.select("node_type", "node_id").unionByName(
        blocks.select(
            F.inline(
                F.array(
                    F.struct(F.col("src_type").alias("node_type"), F.col("src").alias("node_id")),
                    F.struct(F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id")),
                )
            )
        )
    )
    x = needed.distinct().join(features.select("node_type", "node_id", "feature_vec"), ["node_type", "node_id"], "left")
    if default_dim is None:
        x = x.where("feature_vec IS NOT NULL")
    else:
        zeros = F.array_repeat(F.lit(0.0).cast("float"), default_dim)
        x = x.withColumn("feature_vec", F.coalesce("feature_vec", zeros))
    h = materialize(
        x.select("node_type", "node_id", dense({t: [w] for t, w in inputs.items()}, "node_type", "feature_vec").alias("h")),
        "seed-input",
    )
    for i, layer in enumerate(layers):
        drawn = blocks.where(F.col("layer") == i)
        if direction == "out":
            drawn = drawn.select(
                F.col("dst_type").alias("src_type"),
                F.concat(F.lit("rev_"), "rel").alias("rel"),
                F.col("src_type").alias("dst_type"),
                F.col("dst").alias("src"),
                F.col("src").alias("dst"),
            )
        last = i + 1 == len(layers)
        h = layer_step(kind, drawn, h, layer, norms[i] if norms else None, last)
        if not last:
            h = materialize(h, f"seed-state{i}")
    wanted = h.join(seeds.select("node_type", "node_id").distinct(), ["node_type", "node_id"], "left_semi")
    return score_logits(
        wanted.select("node_type", "node_id", dense({"all": head}, F.lit("all"), "h").alias("logits"))
    )


def answer(requests: DataFrame, scores: DataFrame) -> DataFrame:
    """Parsed requests with the score of their node, or the reason why there is none."""
    return with_errors(requests.join(scores, ["node_type", "node_id"], "left"))


def with_errors(scored: DataFrame) -> DataFrame:
    """State why a request has no class, and blank the score fields of such a request."""
    error = F.coalesce(
        "error",
        F.when(F.col("task_type") != CLASSIFY, F.lit("needs link_scores")),
        F.when(F.col("prediction").isNull(), F.lit("unknown node")),
    )
    fields = ["prediction", "confidence", "probabilities"]
    return scored.select(
        *[c for c in scored.columns if c not in (*fields, "error")],
        *[F.when(error.isNull(), F.col(c)).alias(c) for c in fields],
        error.alias("error"),
    )


def batch_score(requests: DataFrame, body: str, **scoring) -> DataFrame:
    """Score every request of a table; each distinct node is scored once."""
    parsed = parse_requests(requests, body)
    seeds = parsed.where(F.col("error").isNull() & (F.col("task_type") == CLASSIFY)).select("node_type", "node_id").distinct()
    return answer(parsed, score_seeds(materialize(seeds, "seeds"), **scoring))


def as_responses(answers: DataFrame) -> DataFrame:
    """One JSON text per answer; empty fields are left out."""
    fields = ["prediction", "confidence", "probabilities", "node_id", "node_type", "error"]
    kept = [c for c in answers.columns if c not in fields and c != "task_type"]
    return answers.select(*kept, F.to_json(F.struct(*fields)).alias("response"))
