"""Removal of passages that occur elsewhere, by suffix arrays over shards.

A byte goes if it lies in a string of ``length`` bytes that also starts at another place of any
document, its own included. Whether a string is repeated is decided by suffix arrays
(``suffix.py``), each over a shard of passages; the steps around them make sure that equal
strings always meet in one shard and that a shard never has to hold a document:

1. Every string of ``length`` bytes has an anchor, the ``GRAM`` bytes in it with the smallest hash.
   Equal strings have equal anchors. Neighbouring strings with the same anchor form one passage, about
   260 bytes for 60 strings.
2. Anchors are counted over the corpus. A string whose anchor occurs once is not repeated.
3. The other passages are counted too, equal ones once each with their number, and go to shards by
   anchor. A passage that is one of very many different ones around the same anchor is cut into
   its strings, which go to shards by their own hash: no anchor can make a shard hot.
4. The shards are sorted, and the repeated strings go back to the texts in which the passage stands.

Texts are told apart by a digest of 128 bits, so copies share one result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, list_array, mix64, utf8
from hetgraph.llm.suffix import _TABLE, _powers, repeated_starts
from hetgraph.runtime import materialize

LENGTH, GRAM = 200, 40
#: Texts are looked at in pieces of this size, and suffix arrays are built over about as much.
PIECE = 1 << 20
#: More different passages than this around one anchor are cut into their strings.
MANY = 5_000
_SEPARATOR = b"\xff"  # no UTF-8 text has it


def _pieces(texts: list[bytes], length: int):
    """``(row, start, bytes)``: texts in overlapping pieces, so that each string lies in one piece."""
    for row, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, PIECE):
            yield row, start, text[start : start + PIECE + length - 1]


def _passages(pieces: list[tuple[int, int, bytes]], length: int) -> dict[str, np.ndarray]:
    """Row, first and last start, anchor and hash of each passage of the pieces."""
    t = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    n, size = len(t), np.array([len(p[2]) for p in pieces])
    first = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        base, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[t] * base[:n], dtype=np.uint64, out=sums[1:])
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
        # Place in the low bits: the smallest is then the leftmost of the smallest hashes.
        low = np.uint64(24)
        least = ((grams >> low) << low) | np.arange(len(grams), dtype=np.uint64)
        wide, width = length - GRAM + 1, 1
        while 2 * width <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
        anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        piece = np.repeat(np.arange(len(pieces)), size)[: len(anchor)]
        valid = np.arange(len(anchor)) + length <= (first + size)[piece]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        lo = np.flatnonzero(new & valid)
        # A passage ends before the next one or with the piece's last whole string.
        starts = np.append(np.flatnonzero(new), len(anchor))
        hi = np.minimum(starts[np.searchsorted(starts, lo, "right")] - 1, (first + size)[piece[lo]] - length)
        end = hi + length
        body = mix64((sums[end] - sums[lo]) * inverse[lo] ^ mix64((end - lo).astype(np.uint64)))
        rows = np.array([p[0] for p in pieces])[piece[lo]]
        shift = np.array([p[1] for p in pieces])[piece[lo]] - first[piece[lo]]
    return {
        "row": rows, "lo": lo + shift, "hi": hi + shift,
        "anchor": grams[anchor[lo]].view(np.int64), "body": body.view(np.int64),
    }


def _find_passages(length: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            keys, held, room = b["key"], [], 0

            def out(held):
                found = _passages(held, length)
                return {"key": keys.take(pa.array(found.pop("row"))), **{k: pa.array(v) for k, v in found.items()}}

            for piece in _pieces(b["text"].to_pylist(), length):
                held.append(piece)
                room += len(piece[2])
                if room >= PIECE:
                    yield out(held)
                    held, room = [], 0
            if held:
                yield out(held)

    return run


def _cut_out(length: int):
    """The bytes of the wanted passages of each text, with the shard they go to."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            cols: dict[str, list] = {k: [] for k in ("shard", "anchor", "body", "skip", "n", "bytes")}
            for text, wanted in zip(b["text"], b["wanted"].to_pylist()):
                text = text.as_py()
                for w in wanted:
                    passage = text[w["lo"] : w["hi"] + length]
                    whole = [(w["anchor"], 0, passage)]
                    if w["many"]:
                        strings = (passage[i : i + length] for i in range(w["hi"] - w["lo"] + 1))
                        whole = [
                            (int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "big", signed=True), i, s)
                            for i, s in enumerate(strings)
                        ]
                    for shard, skip, s in whole:
                        for k, v in zip(cols, (shard, w["anchor"], w["body"], skip, w["n"], s)):
                            cols[k].append(v)
                if len(cols["n"]) > 20_000:
                    yield cols
                    cols = {k: [] for k in cols}
            yield cols

    return run


def _sort_shards(length: int):
    """Suffix arrays over whole shards, about ``PIECE`` bytes at a time. Rows come sorted by shard."""

    def found(held: list[tuple]) -> dict:
        t = np.frombuffer(_SEPARATOR.join(h[4] for h in held) + _SEPARATOR, np.uint8)
        size = np.array([len(h[4]) for h in held])
        first = np.cumsum(size + 1) - size - 1
        weight = np.zeros(len(t), np.int64)
        for f, s, h in zip(first, size, held):
            weight[f : f + s - length + 1] = min(h[3], 2)
        repeated = repeated_starts(t, weight, length)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8))).reshape(-1, 2)
        owner = np.searchsorted(first, edges[:, 0], "right") - 1
        lo, hi = edges[:, 0] - first[owner], edges[:, 1] - 1 - first[owner]
        pick = lambda i, d: np.array([h[i] for h in held], d)[owner]
        skip = pick(2, np.int64)
        return {"anchor": pick(0, np.int64), "body": pick(1, np.int64), "from": lo + skip, "to": hi + skip}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held, room, shard = [], 0, None
        for b in batches:
            columns = [b[c].to_pylist() for c in ("shard", "anchor", "body", "skip", "n", "bytes")]
            for s, *row in zip(*columns):
                if s != shard and room >= PIECE:
                    yield found(held)
                    held, room = [], 0
                shard = s
                held.append(row)
                room += len(row[-1])
        if held:
            yield found(held)

    return run


def _spans_of(marks: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start in ``marks`` (first, last)."""
    out: list[list[int]] = []
    for lo, hi in sorted(marks):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + length)
        else:
            out.append([lo, hi + length])
    return [tuple(x) for x in out]


def _merge(length: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            spans = [_spans_of([(m["from"], m["to"]) for m in row], length) for row in b["marks"].to_pylist()]
            flat = [np.array(s, np.int64).ravel() for s in spans]
            yield {"key": b["key"], "spans": list_array(flat, "int64")}

    return run


def _keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("key", F.unhex(F.md5(utf8(text))))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(key, spans)`` for each different text of ``docs (text, ...)`` that loses bytes.

    ``key`` is the text's md5 digest; ``spans`` holds begin and end of each maximal run, in bytes.
    """
    texts = _keyed(docs.select("text")).select("key", utf8().alias("text")).where(F.length("text") >= length)
    schema = "key binary, lo long, hi long, anchor long, body long"
    passages = materialize(arrow_map(texts, _find_passages(length), schema), "passages")

    twice = passages.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1").select("anchor")
    shared = passages.join(twice, "anchor", "left_semi")
    # Copies of a text have the same passages: once each, with their number.
    placed = materialize(shared.groupBy("key", "lo", "hi", "anchor", "body").agg(F.count("*").alias("n")), "placed")
    kinds = placed.groupBy("anchor", "body").agg(F.sum("n").alias("n"), F.min("key").alias("key"))
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where(F.col("kinds") > MANY).select("anchor", F.lit(True).alias("many"))
    kinds = kinds.join(many, "anchor", "left").select("anchor", "body", "n", "key", F.coalesce("many", F.lit(False)).alias("many"))
    # Where a passage stands several times in its text, any place will do.
    at = placed.groupBy("key", "anchor", "body").agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"))
    wanted = (
        kinds.join(at, ["key", "anchor", "body"])
        .groupBy("key").agg(F.collect_list(F.struct("anchor", "body", "lo", "hi", "n", "many")).alias("wanted"))
    )
    # One text of each group of copies, reduced before the exchange that the join needs anyway.
    once = texts.groupBy("key").agg(F.first("text").alias("text"))
    bodies = arrow_map(
        once.join(wanted, "key").select("text", "wanted"),
        _cut_out(length),
        "shard long, anchor long, body long, skip long, n long, bytes binary",
    )
    sharded = bodies.repartition("shard").sortWithinPartitions("shard", "anchor", "body", "skip")
    schema = "anchor long, body long, from long, to long"
    repeated = materialize(arrow_map(sharded, _sort_shards(length), schema).distinct(), "repeated")

    marks = placed.join(repeated, ["anchor", "body"]).select(
        "key", F.struct((F.col("lo") + F.col("from")).alias("from"), (F.col("lo") + F.col("to")).alias("to")).alias("m")
    )
    return materialize(
        arrow_map(marks.groupBy("key").agg(F.collect_list("m").alias("marks")), _merge(length), "key binary, spans array<long>"),
        "spans",
    )


def _rest(text: bytes, spans: list[int] | None) -> bytes:
    if not spans:
        return text
    ends = [0, *spans, len(text)]
    return b"".join(text[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2))


def _digests(batches: Iterator[dict]) -> Iterator[dict]:
    for b in batches:
        spans = b["spans"].to_pylist()
        rest = (_rest(t.as_py(), s) for t, s in zip(b["text"], spans))
        yield {"key": b["key"], "sha": [hashlib.sha256(r).hexdigest() for r in rest]}


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs (doc_id, text, ...)``.

    Null and empty texts have no bytes; texts shorter than ``length`` lose nothing; null ids and repeated
    rows are rows like all others (a repeated long text loses all of its bytes). Other columns are ignored;
    an empty table gives no rows.
    """
    spans = repeated_spans(docs, length)
    keyed = _keyed(docs.select("doc_id", "text"))
    # Only different texts that lose something are cut; what is lost whole leaves nothing to hash.
    sums = spans.select(
        "key", "spans", (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.aggregate(
            F.sequence(F.lit(0), (F.size("spans") / 2).cast("int") - 1), F.lit(0).cast("long"),
            lambda s, i: s + F.get("spans", 2 * i + 1) - F.get("spans", 2 * i),
        ).alias("n_removed"),
    )
    rows = keyed.select(
        "doc_id", "key", F.length(utf8()).cast("long").alias("n_bytes"), F.sha2(utf8(), 256).alias("sha_all")
    )
    partly = sums.join(rows.select("key", "n_bytes").distinct(), "key").where("n_removed < n_bytes").select("key", "spans")
    once = keyed.select("key", utf8().alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    cut = once.join(partly, "key")
    hashed = arrow_map(cut.select("key", "text", "spans"), _digests, "key binary, sha string")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        rows.join(sums.drop("spans"), "key", "left").join(hashed, "key", "left")
        .select(
            "doc_id", "n_bytes",
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.when(F.col("n_removed").isNull(), F.col("sha_all")).otherwise(F.coalesce("sha", F.lit(nothing))).alias("kept_sha256"),
        )
    )


def _cut_texts(batches: Iterator[dict]) -> Iterator[dict]:
    for b in batches:
        spans = b["spans"].to_pylist()
        yield {"row": b["row"], "text": [_rest(t.as_py(), s).decode("utf-8", "ignore") for t, s in zip(b["text"], spans)]}


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, all columns; no row goes.

    A character that a removed run cuts in two goes whole. ``n_chars``, if there, is counted anew. A
    null text stays null.
    """
    keyed = _keyed(docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "text"))
    joined = keyed.join(repeated_spans(docs, length), "key", "left")
    row = next(f for f in keyed.schema if f.name == "row").dataType.simpleString()
    cut = arrow_map(
        joined.where("spans IS NOT NULL").select("row", utf8().alias("text"), "spans"), _cut_texts, f"row {row}, text string"
    )
    both = joined.where("spans IS NULL").select("row", "text").unionByName(cut)
    columns = [
        F.col("text") if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.{c}")
        for c in docs.columns
    ]
    return both.select(*columns)
