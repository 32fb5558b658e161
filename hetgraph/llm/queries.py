"""The operators as named queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hetgraph.llm.common import table
from hetgraph.llm.sql import mixing_sql, near_duplicates_sql, resampling_sql, rules_sql, vector_codes_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return wrap


@query("op1_near_duplicates", near_duplicates_sql())
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op4_quality_rules", rules_sql())
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import rules

    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_mixture", mixing_sql())
def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_repeated_passages")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import suffix_dedup

    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query("op6_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from hetgraph.llm import sentencepiece_codec

    return sentencepiece_codec.encoded(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query("op3_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from hetgraph.llm import tokenfile

    return tokenfile.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import sharding

    return sharding.sharded(table(spark, sf_dir, "documents"))


@query("op9_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import html_text

    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op10_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import quality_mil

    docs = table(spark, sf_dir, "documents")
    return quality_mil.score(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


@query("op2_nearest")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import ann

    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


@query("op13_resampled", resampling_sql())
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import resampling

    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_vector_codes", vector_codes_sql())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import product_codes

    return product_codes.compress(table(spark, sf_dir, "embeddings"))[0]


@query("op11_simhash")
def simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hetgraph.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))
