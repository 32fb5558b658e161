"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes for a document (1), against it (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns estimates how each rule votes on good and on bad documents, and how
many are good, without labels; a document is kept if its posterior probability of being good is at least
one half. A few hard limits (``base_failed``) stay outside of the vote.

The patterns are counted with a partial aggregation; there are at most 3 ** (number of rules) of
them whatever the size of the corpus. A step of the estimation is one aggregation over that table,
and only its result, six numbers per rule, comes to the driver.
"""

from __future__ import annotations

from functools import reduce
from math import log
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.runtime import materialize

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Frequent words of the four languages of the corpus.
FUNCTION_WORDS = (
    "the of and to in is that it for was on are as with at be this by from have or an not but "
    "der die und den von zu mit das auf ein eine ist im dem des nicht für sich "
    "de la le et les des en un du une est que dans pour qui pas au par sur "
    "el los las por con del se una su para al lo como más"
).split()

MIN_WORDS = 50
STEPS = 20
#: Where the estimation starts: the share of good documents, and how often a rule votes against, abstains
#: and votes for a good and a bad document.
PRIOR_START, GOOD_START, BAD_START = 0.8, (0.05, 0.15, 0.8), (0.5, 0.2, 0.3)
#: Weight of the starting values against the votes.
BELIEF = 0.01
Model = tuple[float, dict[str, tuple[tuple[float, ...], tuple[float, ...]]]]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole-number counts that the rules look at, one row per row of ``docs``."""
    words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select(
        "doc_id", "t", F.array_remove(F.split("t", SPACE + "+"), "").alias("w")
    )
    # Hashes of the 3-word windows, in order.
    windows = words.select(
        "*",
        F.transform(
            F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2)),
        ).alias("h"),
    )
    sortable = windows.select(
        "*",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("s"),
    )
    # Equal windows are neighbours now: keep those that have one, and count the words they cover.
    repeated = sortable.select(
        "*",
        F.filter(
            "s", lambda x, i: (F.get("s", i - 1)["h"] == x["h"]) | (F.get("s", i + 1)["h"] == x["h"])
        ).alias("r"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"),
    )
    covered = F.array_distinct(F.flatten(F.transform("r", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    long = lambda c: c.cast("long")
    return repeated.select(
        "doc_id",
        long(F.size("w")).alias("n_words"),
        long(F.length(F.array_join("w", ""))).alias("word_chars"),
        long(F.regexp_count("t", F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(F.coalesce(F.size(covered), F.lit(0))).alias("n_repeat_words"),
        long(F.size("l")).alias("n_lines"),
        long(F.regexp_count("t", F.lit("[A-Z]"))).alias("n_upper"),
        long(F.regexp_count("t", F.lit("[a-z]"))).alias("n_lower"),
        long(F.size(F.filter("w", lambda w: F.lower(w).isin(FUNCTION_WORDS)))).alias("n_function"),
        long(F.size(F.array_distinct("w"))).alias("n_distinct"),
    ).withColumn("n_repeat_words", F.greatest("n_repeat_words", F.lit(0)))


def _vote(good: str, bad: str) -> Column:
    return F.when(F.expr(bad), F.lit(-1)).when(F.expr(good), F.lit(1)).otherwise(F.lit(0))


#: Name: (condition to vote for, condition to vote against), both over the counts. Whole numbers
#: only, so that any engine finds the same votes.
RULES = {
    "symbols": ("20 * n_symbols <= n_words", "10 * n_symbols > 3 * n_words"),
    "repeats": ("10 * n_repeat_words <= n_words", "10 * n_repeat_words > 4 * n_words"),
    "lines": ("n_dup_lines = 0 AND n_lines > 1", "10 * n_dup_lines > 3 * n_lines"),
    "capitals": ("5 * n_upper <= n_lower", "n_upper > n_lower"),
    "word_length": (
        "word_chars >= 3 * n_words AND word_chars <= 9 * n_words",
        "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    ),
    "function_words": ("20 * n_function >= n_words", "100 * n_function < n_words"),
    "variety": ("10 * n_distinct >= 3 * n_words", "20 * n_distinct < n_words"),
}
BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"


def _log_odds(model: Model) -> Column:
    """Of being good, by the votes in the columns."""
    good, rates = model
    terms = [
        F.get(F.array(*(F.lit(log(g / b)) for g, b in zip(*rates[r]))), F.col(f"v_{r}") + 1) for r in RULES
    ]
    return reduce(add, terms, F.lit(log(good / (1 - good))))


def _posterior(model: Model) -> Column:
    return 1 / (1 + F.exp(-_log_odds(model)))


def estimate(votes: DataFrame, steps: int = STEPS) -> Model:
    """The share of good documents, and how often each rule votes -1, 0 and 1 on good and on bad ones.

    ``votes`` has one column ``v_<rule>`` per rule. The starting rates also count as ``BELIEF`` times
    as many documents as there are, so no rate becomes zero. A table without rows gives the start.
    """
    columns = [f"v_{r}" for r in RULES]
    patterns = materialize(votes.groupBy(*columns).agg(F.count("*").alias("n")), "patterns")
    model = (PRIOR_START, dict.fromkeys(RULES, (GOOD_START, BAD_START)))
    for _ in range(steps):
        known = patterns.withColumn("g", F.col("n") * _posterior(model))
        sums = [
            F.sum(F.when(F.col(c) == v, F.col(weight)).otherwise(0)).alias(f"{weight}_{i}_{v + 1}")
            for i, c in enumerate(columns)
            for v in (-1, 0, 1)
            for weight in ("n", "g")
        ]
        row = known.agg(F.sum("n").alias("n"), F.sum("g").alias("g"), *sums).first()
        if not row["n"]:
            break
        n, g, held = row["n"], row["g"], BELIEF * row["n"]
        rates = {
            r: (
                tuple((row[f"g_{i}_{v}"] + held * GOOD_START[v]) / (g + held) for v in range(3)),
                tuple((row[f"n_{i}_{v}"] - row[f"g_{i}_{v}"] + held * BAD_START[v]) / (n - g + held) for v in range(3)),
            )
            for i, r in enumerate(RULES)
        }
        model = ((g + held * PRIOR_START) / (n + held), rates)
    return model


def judge(docs: DataFrame, steps: int = STEPS) -> DataFrame:
    """The counts of every row of ``docs (doc_id, text, ...)``, its votes, ``base_failed``,
    ``posterior`` and ``kept``.

    A null text has no words and fails. Null ids and repeated rows are judged like all others; other
    columns are ignored; an empty table gives no rows.
    """
    votes = [_vote(*conditions).alias(f"v_{r}") for r, conditions in RULES.items()]
    voted = materialize(features(docs).select("*", *votes, F.expr(BASE_FAILED).alias("base_failed")), "votes")
    model = estimate(voted.where("NOT base_failed"), steps)
    return voted.select(
        "*", _posterior(model).alias("posterior"), (~F.col("base_failed") & (_log_odds(model) >= 0)).alias("kept")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    rows = docs.select(F.struct(*docs.columns).alias("doc_id"), "text")
    return judge(rows).where("kept").select("doc_id.*")
