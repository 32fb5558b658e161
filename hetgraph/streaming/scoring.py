"""Streaming request scoring: parse, look up, score, answer as JSON. Stateless.

``score_stream`` runs each micro-batch as a batch job, so that the features are reduced to the batch's keys before
they are shuffled, and writes the answers of a batch to a folder of its own, which a batch that runs again
replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hetgraph.functions.vectors import Linear, dense
from hetgraph.operators.features import get_features
from hetgraph.operators.layers import score_logits
from hetgraph.operators.serving import as_responses, parse_requests, with_errors


def score_requests(requests: DataFrame, features: DataFrame, chain: list[Linear], body: str = "body") -> DataFrame:
    """Answers for a stream or a table of requests: a network on the stored vector of the node.

    ``features`` is a table; with a stream of requests this is a stream-static join.
    """
    dim = chain[0][0].shape[1]
    looked_up = get_features(parse_requests(requests, body), features, default_dim=dim)
    logits = looked_up.withColumn("logits", dense({"all": chain}, F.lit("all"), "feature_vec")).drop("feature_vec")
    return as_responses(with_errors(score_logits(logits)))


def write_responses(responses: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        responses.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def score_batch(requests: DataFrame, batch_id: int, features: DataFrame, chain: list[Linear], path: str) -> None:
    """Answers of one micro-batch, in ``path/batch=<id>``."""
    answers = score_requests(requests, features, chain)
    answers.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def score_stream(
    requests: DataFrame, features: DataFrame, chain: list[Linear], path: str, checkpoint: str
) -> StreamingQuery:
    """Score all requests of a stream that are available now and end.

    Spark gives a batch that has to run again the same rows and the same id: its answers replace those of
    the first attempt, whole, and every request is answered once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, batch_id, features, chain, path)

    return (
        requests.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
