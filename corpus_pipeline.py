"""From raw documents to token ids: rules, near-duplicates, repeated passages, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor kept; all but the last
return the columns of ``docs``. Between the stages the documents are a Parquet table: when a stage starts, its
predecessor's result has been written, and what that stage had put aside on its way is deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from hetgraph.llm import minhash, mixing, rules, sentencepiece_codec, suffix_dedup
from hetgraph.llm.common import table
from hetgraph.runtime import drop_tables, materialize, recorded

#: Tables that the stage before has put aside.
_aside: list[str] = []


def stage(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _aside)
        _aside.clear()
        with recorded() as paths:
            result = f(spark, docs, sf_dir)
        _aside.extend(paths)
        return result

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.keep_good(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    return minhash.keep_one(docs, words=5, percent=80)


@stage
def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur elsewhere are cut out of the texts."""
    return suffix_dedup.without_repeats(docs)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source gives its share of words; small sources repeat up to three times."""
    return mixing.mixed(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, ids, n_ids, round_trip)`` of every document of the mix."""
    import public_tokenizers

    return sentencepiece_codec.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mixture", mixture),
    ("encode", encode),
]

#: Induced sorting, the rules' estimation and the encoding have no SQL; tests/llm holds the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = materialize(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
