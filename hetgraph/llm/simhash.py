"""Near-duplicate documents by SimHash fingerprints of 64 bits (Charikar, 2002), linked at few differing bits.

A fingerprint bit says whether more than half of the document's shingle hashes have it. Equal fingerprints are
one class; classes are linked through an inverted index on the bytes of the fingerprint and their positions.

Two fingerprints that differ in at most ``bits`` bits share at least ``8 - bits`` of their 8 positional bytes: the
guaranteed minimum. A posting list of one byte would hold a 256th of the table and its pairs grow with the
square of it, so an entry of the index is a choice of positions with the bytes that stand there: the positions are
taken in twos, and of these groups as many as no differing bit can spoil make a choice. Some
choice is shared by every pair that reaches the minimum. In each list the shared positional bytes of its pairs are
tallied, block by block, those that reach the minimum are verified bit by bit, and a spanning forest of the links leaves
the task: never a row per pair.

Lists of more than ``LIST`` classes are dealt anew by every choice of ``8 - bits`` positions. All of such a list then
agrees in everything but ``bits`` bytes, so it holds at most 256 ** bits classes, whatever the table holds, and instead of
comparing pairs each class looks up the few values within ``bits`` bits of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, components, utf8
from hetgraph.runtime import materialize

WORDS, SEED, BITS = 3, 42, 2
#: Classes of a list whose pairs are tallied, rows of a block of them, and shingles hashed at a time.
LIST, BLOCK, SHINGLES = 2_048, 256, 65_536


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Unsigned; 0 for a text without words."""
    found = text.lower().split()
    k = min(words, len(found))
    if not k:
        return 0
    n, ones = len(found) - k + 1, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        some = found[at : min(n, at + SHINGLES) + k - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(k))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", min(SHINGLES, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            prints = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b["text"]), np.uint64, len(b["text"]))
            yield {"doc_id": b["doc_id"], "print": prints.view(np.int64)}

    return run


def _masks(positions: list[tuple[int, ...]]) -> list[int]:
    """As signed longs: all bits of the bytes at the positions."""
    masks = [sum(0xFF << (8 * p) for p in chosen) for chosen in positions]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def entries(bits: int) -> list[int]:
    """Masks of the choices of positions of which every pair within ``bits`` bits shares one."""
    groups = [(0, 1), (2, 3), (4, 5), (6, 7)] if bits < 4 else [(p,) for p in range(8)]
    return _masks([sum(c, ()) for c in combinations(groups, len(groups) - bits)])


def choices(bits: int) -> list[int]:
    """Masks of all choices of the guaranteed minimum of positions."""
    return _masks(list(combinations(range(8), 8 - bits)))


def _postings(prints: DataFrame, masks: list[int]) -> DataFrame:
    """``(entry, bytes, print)``: one row per fingerprint and entry of the index."""
    rows = F.array(*[F.struct(F.lit(i).alias("entry"), F.col("print").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)])
    return prints.select(F.inline(rows), "print")


def _bytes_of(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint8).reshape(len(x), 8)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links."""
    name = np.arange(n)
    while True:
        least = np.minimum(name[a], name[b])
        new = name.copy()
        np.minimum.at(new, name[a], least)
        np.minimum.at(new, name[b], least)
        new = new[new]
        if (new == name).all():
            return name
        name = new


def tallied(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a list that differ in at most ``bits`` bits."""
    each, a_out, b_out = _bytes_of(prints), [], []
    for at in range(0, len(prints), BLOCK):
        mine = each[at : at + BLOCK]
        shared = np.zeros((len(mine), len(prints)), np.uint8)
        for p in range(8):
            shared += mine[:, p, None] == each[None, :, p]
        a, b = np.nonzero(shared >= 8 - bits)
        a = a + at
        a, b = a[a < b], b[a < b]
        near = np.bitwise_count(prints[a] ^ prints[b]) <= bits
        a_out.append(a[near])
        b_out.append(b[near])
    return np.concatenate(a_out), np.concatenate(b_out)


def looked_up(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``tallied`` for a sorted list, by looking for every value within ``bits`` bits in the bytes that vary."""
    varies = np.bitwise_or.reduce(prints ^ prints[0])
    free = [1 << i for i in range(64) if int(varies) >> i & 1]
    a_out, b_out = [], []
    for n in range(1, bits + 1):
        for some in combinations(free, n):
            want = prints ^ np.uint64(sum(some))
            at = np.searchsorted(prints, want)
            at[at == len(prints)] = 0
            a = np.flatnonzero((prints[at] == want) & (prints < want))
            a_out.append(a)
            b_out.append(at[a])
    none = np.zeros(0, np.int64)
    return np.concatenate(a_out or [none]), np.concatenate(b_out or [none])


def _linked(bits: int):
    """A spanning forest of the links of every list."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            a_out, b_out = [], []
            for lists in b["prints"]:
                prints = np.sort(lists.values.to_numpy().view(np.uint64))
                small = len(prints) <= LIST
                found = tallied(prints, bits) if small else looked_up(prints, bits)
                name = _forest(len(prints), *found)
                at = np.flatnonzero(name < np.arange(len(prints)))
                a_out.append(prints[at].view(np.int64))
                b_out.append(prints[name[at]].view(np.int64))
            yield {"a": np.concatenate(a_out), "b": np.concatenate(b_out)}

    return run


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints of ``prints (print)`` within ``bits`` bits of each other.

    Everything that such links reach from each other is also reached through the rows returned.
    """
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3")
    spark = prints.sparkSession
    index = _postings(prints, entries(bits))
    sizes = index.groupBy("entry", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialize(sizes, "lists")
    shared = index.join(sizes, ["entry", "bytes"])
    gather = lambda df: df.groupBy("entry", "bytes").agg(F.collect_list("print").alias("prints"))
    lists = gather(shared.where(F.col("n") <= LIST))
    hot = shared.where(F.col("n") > LIST).select("print").distinct()
    lists = lists.unionByName(gather(_postings(hot, choices(bits))).where("size(prints) > 1"))
    # A list may hold as many numbers as LIST or 256 ** bits, so few at a time go to Python.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, 256)
    try:
        return materialize(arrow_map(lists.select("prints"), _linked(bits), "a long, b long"), "links")
    finally:
        spark.conf.set(name, usual)


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs (doc_id, text, ...)``.

    Words are what stands between the six ASCII white-space characters, A-Z lower-cased. Shingles are ``words`` words,
    repeats included; a shorter text is one shingle. Null, empty and blank texts have the fingerprint zero and are linked
    like others. ``component_id`` is the smallest doc_id that links reach, itself included. Rows without a doc_id
    link others and get the component of those, null if there is none. Repeated rows give repeated rows. Other
    columns are ignored; an empty table gives no rows.
    """
    printed = materialize(
        arrow_map(docs.select("doc_id", utf8().alias("text")), _fingerprints(words, seed), "doc_id long, print long"),
        "prints",
    )
    classes = materialize(printed.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    groups = components(links(classes.select("print"), bits)).toDF("print", "component")
    named = classes.join(groups, "print", "left").withColumn("component", F.coalesce("component", "print"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = materialize(named.join(smallest, "component").select("print", "component_id"), "of_class")
    return printed.join(of_class, "print").select("doc_id", _digits("print").alias("fingerprint"), "component_id")


def _digits(print_: str) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))
