"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash. A source that is to give a fraction of its words takes the
documents whose hash lies under a threshold, so that a smaller budget takes a subset of a larger
one and reruns agree. The threshold is found without sorting documents: words are summed by source and
hash bucket, the bucket in which the budget ends is found, and only that bucket is cut into finer
buckets, until a bucket is a single hash. Whole copies come first: a target of 2.4 times
the source's size takes everything twice and 40 % once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hetgraph.llm.common import WORD
from hetgraph.operators.ids import with_row_index
from hetgraph.runtime import materialize

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
HASH_DIGITS, DIGITS_A_LEVEL = 15, 3
KEY = ["no_source", "source"]


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, the source as a key without nulls, words and a hash of 60 bits."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select(
        "doc_id",
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long").alias("h"),
    )


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Per source ``source_size``, ``target``, whole ``copies`` and the ``rest`` to be taken by hash.

    Sources in code-point order, null last, have the weights in turn. They share the sum of all
    sizes by weight; none gets more than ``most`` times its size, and the excess is shared again by weight. One aggregation
    over the sources per round; two numbers come to the driver.
    """
    ranked = materialize(
        with_row_index(sizes.groupBy(*KEY).agg(F.sum("size").alias("source_size")), KEY, "i").select(
            *KEY, "source_size", F.get(F.array(*map(F.lit, weights)), (F.col("i") % len(weights)).cast("int")).alias("w")
        ),
        "sources",
    )
    exact = lambda c: c.cast("decimal(38,0)")
    rest, shares, before = None, None, -1
    capped = F.lit(False)
    while True:
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(capped, F.col("source_size") * most).otherwise(0)).alias("fixed"),
            F.sum(F.when(capped, 0).otherwise(F.col("w"))).alias("w"),
            F.count_if(capped).alias("n"),
        ).first()
        if row["n"] == before or not row["w"]:
            break
        before, rest, shares = row["n"], row["all"] - row["fixed"], row["w"]
        capped = exact(F.col("w")) * F.lit(rest) > exact(F.col("source_size")) * F.lit(most * shares)
    if rest is None:
        rest, shares = 0, 1
    # A weight times a sum of words needs more than the 32 bits of both, and a quotient that is rounded may reach the next copy.
    size = exact(F.col("source_size"))
    share = F.when(capped, size * F.lit(most * shares)).otherwise(exact(F.col("w")) * F.lit(rest))
    parts = ranked.withColumn("share", exact(share)).withColumn("whole", exact(size * F.lit(shares)))
    copies = F.when(F.col("source_size") > 0, F.expr("share div whole")).otherwise(0).cast("long")
    left = exact(F.col("share") - exact(F.col("copies")) * F.col("whole"))
    return parts.withColumn("copies", copies).withColumn("left", left).select(
        *KEY,
        "source_size",
        (F.col("share").cast("double") / F.lit(float(shares))).alias("target"),
        "copies",
        F.expr(f"left div {shares}").alias("rest"),
    )


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted (source key, rest)`` with ``cut``: hashes below it are taken once more, as is ``cut``
    itself where ``with_cut`` says that this comes nearer to ``rest``."""
    state = wanted.select(*KEY, "rest", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"))
    for level in range(HASH_DIGITS // DIGITS_A_LEVEL):
        digits = DIGITS_A_LEVEL * (level + 1)
        shift = 4 * (HASH_DIGITS - digits)
        bucket = F.shiftright("h", shift)
        inside = sizes.where("size > 0").select(*KEY, "size", bucket.alias("bucket"))
        # The first level looks at all documents, the next ones at one bucket per source.
        if level:
            inside = inside.withColumn("prefix", F.shiftright("bucket", 4 * DIGITS_A_LEVEL)).join(
                state.select(*KEY, "prefix"), [*KEY, "prefix"], "left_semi"
            )
        histogram = inside.groupBy(*KEY, "bucket").agg(F.sum("size").alias("m"))
        ordered = W.partitionBy(*KEY).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        sums = histogram.withColumn("upto", F.sum("m").over(ordered))
        state = materialize(
            sums.join(state.select(*KEY, "rest", "below"), KEY)
            .where("below + upto - m <= rest AND below + upto > rest")
            .select(*KEY, "rest", (F.col("below") + F.col("upto") - F.col("m")).alias("below"), F.col("bucket").alias("prefix"), "m"),
            "thresholds",
        )
    return state.select(
        *KEY, F.col("prefix").alias("cut"), (F.col("below") + F.col("m") - F.col("rest") < F.col("rest") - F.col("below")).alias("with_cut")
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``doc_id``, source key, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` for every row of ``docs (doc_id, text, source, ...)``.

    ``size`` is the number of words, ``taken`` how many of them the mix takes with repeats. A source
    gets its target to within half of one document. Null texts have no words; a null source is a source of its own;
    rows with equal ids share their hash and so their fate; null ids count as equal. Other columns are ignored;
    an empty table gives no rows.
    """
    sizes = materialize(sized(docs), "sizes")
    wanted = materialize(targets(sizes, weights, most), "targets")
    cuts = thresholds(sizes, wanted.where("source_size > 0"))
    plan = wanted.join(cuts, KEY, "left")
    more = (F.col("h") < F.col("cut")) | ((F.col("h") == F.col("cut")) & F.col("with_cut"))
    copies = (F.col("copies") + F.coalesce(more, F.lit(False)).cast("long")).alias("copies")
    return sizes.join(plan, KEY).select("doc_id", *KEY, "size", "source_size", "target", copies).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns."""
    row = F.struct(*docs.columns).alias("row")
    keyed = docs.select(row, "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"))
    copies = mix(docs, **options).where("copies > 0").select(
        F.col("doc_id").alias("id"), F.col("no_source").alias("no_s"), F.col("source").alias("s"), "copies"
    )
    same = keyed["doc_id"].eqNullSafe(copies["id"]) & (keyed["no_source"] == copies["no_s"]) & (keyed["source"] == copies["s"])
    once = keyed.join(copies.distinct(), same)
    return once.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
