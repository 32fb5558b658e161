"""Importance resampling towards a target, after Xie et al. (2023), on hashed n-grams.

Both corpora are seen as bags of hashed n-grams. What a bucket is worth (its gain) is the logarithm of
its share in the target over its share in the documents, both smoothed by one; a document weighs the sum
of its n-grams' gains. Gumbel noise from the document's id is added, and the highest scores are drawn: the
same as drawing without replacement in proportion to the weights.

Words come from bytes: a table of 256 bytes lower-cases A-Z and blanks everything but a-z, 0-9 and the
bytes of characters beyond ASCII, and ``bytes.split`` gives the words. The bucket of an n-gram is its
crc32; the one of n words is the seed from which the one of n + 1 words goes on. Each task adds up its
n-grams in one counter per batch and one array of buckets; only the buckets are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, utf8
from hetgraph.operators.ids import with_row_index
from hetgraph.runtime import materialize

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
PERCENT, LEAST_WORDS = 10, 20
#: So many gains of n-grams are remembered by a task at a time.
REMEMBERED = 500_000

#: Lower-case letters and digits stay, capitals become lower-case, other ASCII becomes a blank.
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in (ord(chr(b).lower()) if b < 0x80 else b for b in range(256))
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def ngrams(words: list[bytes], longest: int) -> Counter:
    """How often every run of 1 to ``longest`` words occurs, by its crc32."""
    counts: Counter = Counter()
    for word, times in Counter(words).items():
        counts[crc32(word)] += times
    if longest > 1:
        seeds = [crc32(w) for w in words]
        for n in range(1, longest):
            seeds = [crc32(w, crc32(b" ", s)) for s, w in zip(seeds, words[n:])]
            counts.update(seeds)
    return counts


def _tally(longest: int, buckets: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            seen: Counter = Counter()
            for text in b["text"]:
                words = words_of(text.as_py())
                if longest == 1:
                    seen.update(words)
                else:
                    for crc, n in ngrams(words, longest).items():
                        total[crc % buckets] += n
                if len(seen) > REMEMBERED:
                    _drain(seen, total)
            _drain(seen, total)
        used = np.flatnonzero(total)
        yield {"bucket": used, "n": total[used]}

    return run


def _drain(seen: Counter, total: np.ndarray) -> None:
    for word, n in seen.items():
        total[crc32(word) % len(total)] += n
    seen.clear()


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams per bucket over all rows of ``texts (text, ...)``: ``buckets`` numbers."""
    parts = arrow_map(texts.select(utf8().alias("text")), _tally(longest, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    # At most one row per bucket.
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """``floor(1000 * ln(...))`` of the smoothed shares, per bucket."""
    k = len(source)
    s_all, t_all = float(source.sum() + k), float(target.sum() + k)
    return [
        floor(1000 * log((float(t + 1) * s_all) / (float(s + 1) * t_all)))
        for s, t in zip(source.tolist(), target.tolist())
    ]


class _Gains(dict):
    """Gain of a word; forgets all when there are too many."""

    def __init__(self, table: list[int]):
        self.table = table

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.table[crc32(word) % len(self.table)]
        return found


def _weigh(table: list[int], longest: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        known = _Gains(table)
        for b in batches:
            n_words, n_features, weight = [], [], []
            for text in b["text"]:
                words = words_of(text.as_py())
                n_words.append(len(words))
                if longest == 1:
                    n_features.append(len(words))
                    weight.append(sum(map(known.__getitem__, words)))
                else:
                    found = ngrams(words, longest)
                    n_features.append(found.total())
                    weight.append(sum(table[c % len(table)] * n for c, n in found.items()))
            yield {"doc_id": b["doc_id"], "n_words": n_words, "n_features": n_features, "weight": weight}

    return run


def noise(doc_id: str = "doc_id", seed: int = SEED):
    """``floor(-1000 * ln(-ln(u)))`` with ``u`` from the first 32 bits of sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs (doc_id, text, ...)``.

    ``target (text, ...)`` says what the draw should look like. Of the N documents with at least ``least_words`` words the
    ``floor(percent * N / 100)`` with the highest scores get a rank from 1; ties go to the smaller doc_id. The others have
    none. Null texts are empty ones: no feature, weight zero. An empty target leaves the smoothing alone to decide. Rows
    with one doc_id share its noise and are ranked apart, those that tie in every column in any order; a null doc_id has
    the noise of an empty one and comes first among ties. Other columns are ignored; an empty table gives no rows.
    """
    table = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    weighed = arrow_map(
        docs.select("doc_id", utf8().alias("text")),
        _weigh(table, longest),
        "doc_id long, n_words long, n_features long, weight long",
    )
    scored = weighed.select(
        "doc_id",
        "n_features",
        "weight",
        (F.col("weight") + noise(seed=seed)).alias("score"),
        (F.col("n_words") < least_words).alias("__short"),
    )
    scored = materialize(scored, "scored").withColumn("__low", -F.col("score"))
    drawn = percent * scored.where("NOT __short").count() // 100
    # The hash keeps rows that share a doc_id and a score, as copies without an id do, from making one sort range.
    spread = scored.withColumn("__spread", F.when(F.col("doc_id").isNull(), F.rand(seed)).otherwise(F.lit(0.0)))
    placed = with_row_index(spread, ["__short", "__low", "doc_id", "__spread", "n_features", "weight"], "__at")
    return placed.select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("__at") < drawn, F.col("__at") + 1).alias("rank")
    )
