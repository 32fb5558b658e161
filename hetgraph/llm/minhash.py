"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is the set of its distinct shingles: ``words`` consecutive words, lower-cased A-Z; a
shorter document is one shingle. Two documents are linked if the Jaccard similarity of their
sets is at least ``percent`` / 100, decided on the full sets with whole numbers.

The sketch (Dahlgaard, Knudsen and Thorup, 2017) has ``bins`` coordinates. In round i of the
first ``bins`` rounds every shingle falls into one hashed bin with the value i + fraction; in the
next ``bins`` rounds all shingles fall into bin i. A coordinate is the smallest value that fell
into its bin. The second half guarantees that each coordinate is filled, and rounds after the
one that fills the last bin cannot change it, so a set of n shingles costs about
``n + bins * log(bins)`` hashes instead of ``n * bins``.

Equal sets are one class and sketched coordinates are compared between classes only. With 32 bands
of 5 coordinates two sets at 0.8 share no band with a probability of 3e-6.

Within a bucket pairs are not expanded. In rounds every class is compared with one class that it
shares a bucket with; what turns out similar is contracted. Then only classes that share a bucket *and*
still lie in different components are compared, whole components in blocks, so a bucket that
holds a large group of copies costs its size once per outsider. Every pair that shares a bucket
is therefore either linked by a path of verified links or was compared itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, components, list_array, mix64, utf8
from hetgraph.runtime import materialize

BANDS, ROWS = 32, 5
#: Candidates are verified unless their sketches agree so seldom that a pair at the wanted similarity does so with
#: at most this probability: well below that of sharing no band.
LOSS = 1e-8
#: So many classes, or so many bytes of their sets, are compared with as many others at a time.
BLOCK, BLOCK_BYTES = 128, 8_000_000
#: Rounds of single comparisons go on while more than this share of them finds a link.
WORTH = 0.25
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    k = min(words, len(h))
    with np.errstate(over="ignore"):
        out = h[: len(h) - k + 1]
        for i in range(1, k):
            out = mix64(out * _GOLDEN + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """``bins`` coordinates as unsigned 64-bit numbers: the round in the high bits."""
    shift, n = np.uint64(52), len(shingles)
    best = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    done = 0
    with np.errstate(over="ignore"):
        while done < 2 * bins:
            # So many rounds at once as will usually fill all bins.
            rounds = np.arange(done, min(2 * bins, done + max(1, int(1.2 * bins * (np.log(bins) + 1) / n))), dtype=np.uint64)
            hashes = mix64(shingles[None, :] + mix64((rounds + np.uint64(1)) * _GOLDEN)[:, None])
            bin_of = (hashes >> np.uint64(40)) % np.uint64(bins)
            fixed = rounds >= bins
            bin_of[fixed] = (rounds[fixed] - np.uint64(bins))[:, None]
            values = (rounds << shift)[:, None] | (mix64(hashes) >> np.uint64(12))
            np.minimum.at(best, bin_of.ravel().astype(np.int64), values.ravel())
            done = int(rounds[-1]) + 1
            if best.max() >> shift < done:
                break
    return best


def sketch_floor(percent: int, bins: int) -> float:
    """The share of equal coordinates under which a pair at ``percent`` falls with at most ``LOSS``."""
    p, below = percent / 100, 0.0
    for c in range(bins):
        below += comb(bins, c) * p**c * (1 - p) ** (bins - c)
        if below > LOSS:
            return c / bins
    return 1.0


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _GOLDEN
        for column in coordinates[: bands * rows].reshape(bands, rows).T:
            key = mix64(key ^ column) * _GOLDEN
    return key.view(np.int64)


def _sketches(words: int, bands: int, rows: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for at in range(0, len(b["text"]), 1000):
                ids, texts = b["doc_id"][at : at + 1000], b["text"][at : at + 1000].to_pylist()
                n, node, keys, marks = [], [], [], []
                for text in texts:
                    s = shingle_set(text, words)
                    n.append(len(s))
                    if not len(s):
                        node.append(None)
                        keys.append(np.zeros(0, np.int64))
                        marks.append(None)
                        continue
                    c = sketch(s, bands * rows)
                    node.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63)
                    keys.append(band_keys(c, bands, rows))
                    marks.append(mix64(c).astype(np.uint8).tobytes())
                yield {"doc_id": ids, "n": n, "node": node, "keys": list_array(keys, "int64"), "marks": marks}

    return run


def _sets(words: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for at in range(0, len(b["text"]), 1000):
                texts = b["text"][at : at + 1000].to_pylist()
                sets = [shingle_set(t, words) for t in texts]
                node = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 for s in sets]
                yield {"node": node, "shingles": [s.tobytes() for s in sets]}

    return run


def _similar(percent: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            keep = []
            for x, y in zip(b["sx"], b["sy"]):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield {"a": b["a"].filter(keep), "b": b["b"].filter(keep)}

    return run


def _blocks_linked(percent: int, floor: float):
    """Verified links between the two blocks of a row: enough to connect all components that are linked."""

    def parts(block):
        block = block.values
        return [block.field(c).to_pylist() for c in ("node", "component", "marks", "shingles")]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            a_out, b_out = [], []
            for hosts, guests in zip(b["hosts"], b["guests"]):
                names, owners, marks, sets = parts(hosts)
                marks = np.frombuffer(b"".join(marks), np.uint8).reshape(len(names), -1)
                sets = [np.frombuffer(x, np.uint64) for x in sets]
                group: dict[int, int] = {}

                def find(x):
                    while group.get(x, x) != x:
                        x = group[x]
                    return x

                for node, owner, mark, own in zip(*parts(guests)):
                    alike = (marks == np.frombuffer(mark, np.uint8)).mean(axis=1)
                    close = np.flatnonzero(alike >= floor)
                    close = close[np.argsort(-alike[close], kind="stable")]
                    own = np.frombuffer(own, np.uint64)
                    for at in range(0, len(close), 64):
                        some = [i for i in close[at : at + 64] if find(owners[i]) != find(owner)]
                        if not some:
                            continue
                        sizes = np.array([len(sets[i]) for i in some])
                        every = np.concatenate([sets[i] for i in some])
                        where = np.searchsorted(own, every)
                        where[where == len(own)] = 0
                        both = np.add.reduceat(own[where] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
                        for hit in np.flatnonzero(100 * both >= percent * (len(own) + sizes - both)):
                            x, y = find(owners[some[hit]]), find(owner)
                            if x != y:
                                group[x] = y
                                a_out.append(names[some[hit]])
                                b_out.append(node)
            yield {"a": a_out, "b": b_out}

    return run


def _across(shared: DataFrame, groups: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, bins: int) -> DataFrame:
    """Verified links ``(a, b)`` between any two components that share a bucket.

    The component with most members in a bucket is its host, the other members are the host's guests.
    Guests are compared with the host's members and with each other in blocks, whole sets at hand, so
    that no row stands for a pair: sketches first, then the sets of those that are near enough.
    """
    spark = shared.sparkSession
    now = materialize(_placed(shared, groups), "placed")
    mixed = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    members = now.join(mixed.select("key"), "key", "left_semi")
    parts = members.groupBy("key", "component").agg(F.count("*").alias("m"))
    largest = parts.groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("host"))
    visits = materialize(
        members.join(largest, "key").where("component <> host").select("host", "node").distinct(), "guests"
    )
    nodes = now.select("node", "component").distinct()
    full = materialize(nodes.join(reps.select("node", "marks"), "node").join(sets, "node").dropDuplicates(["node"]), "members")
    item = F.struct("node", "component", "marks", "shingles")
    hosting = visits.select(F.col("host").alias("component")).distinct()
    # As many blocks as the members' number or the bytes of their sets ask for.
    blocks_of = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("shingles")) / BLOCK_BYTES)).alias("n")
    sizes = full.groupBy("component").agg(blocks_of)
    # Dealt by host and block: the members of one component may be any share of all rows.
    hosts = (
        full.join(hosting.join(sizes, "component"), "component")
        .withColumns({"host": F.col("component"), "hb": F.expr("pmod(xxhash64(node), n)")}).repartition("host", "hb")
        .groupBy("host", "hb").agg(F.collect_list(item).alias("hosts"))
    )
    visiting = full.join(visits, "node")
    guests = materialize(
        visiting.join(visiting.groupBy("host").agg(blocks_of), "host")
        .withColumn("gb", F.expr("pmod(xxhash64(node), n)")).repartition("host", "gb")
        .groupBy("host", "gb").agg(F.collect_list(item).alias("guests")),
        "guest_blocks",
    )
    others = guests.select("host", F.col("gb").alias("hb"), F.col("guests").alias("hosts"))
    blocks = (
        hosts.join(guests, "host").select("hosts", "guests")
        .unionByName(others.join(guests, "host").where("hb <= gb AND (hb < gb OR size(guests) > 1)").select("hosts", "guests"))
    )
    # A row holds up to some hundred sets, so few rows at a time go to Python.
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(rows)
    spark.conf.set(rows, 4)
    try:
        run = _blocks_linked(percent, sketch_floor(percent, bins))
        return materialize(arrow_map(blocks, run, "a long, b long"), "across")
    finally:
        spark.conf.set(rows, usual)


def _with_both(pairs: DataFrame, nodes: DataFrame, column: str, x: str, y: str) -> DataFrame:
    """The pairs with one column of either end."""
    return pairs.join(nodes.select(F.col("node").alias("a"), F.col(column).alias(x)), "a").join(
        nodes.select(F.col("node").alias("b"), F.col(column).alias(y)), "b"
    )


def _placed(shared: DataFrame, groups: DataFrame) -> DataFrame:
    return shared.join(groups, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups (node, component)`` after new links between nodes."""
    ends = [
        groups.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b")
    ]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    moved = components(between).toDF("component", "to")
    # A node without a row in ``groups`` is a component of its own.
    known = groups.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    new = moved.join(groups.select(F.col("node").alias("component")), "component", "left_anti").select(
        F.col("component").alias("node"), F.col("to").alias("component")
    )
    return materialize(known.unionByName(new), "groups")


def _by_stars(shared: DataFrame, verified) -> DataFrame:
    """``(node, component)`` after rounds in which every class is compared with one other class.

    A round draws one class per bucket; a class that lies in another component than one it shares a
    bucket with is compared with it, with one of them if there are several. Rounds go on while they
    find links often enough: a group of copies of any size is one component after a few of them.
    """
    spark = shared.sparkSession
    groups, turn, met = spark.createDataFrame([], "node long, component long"), 0, True
    while met:
        turn += 1
        now = _placed(shared, groups)
        order = lambda c: F.xxhash64(F.col(c), F.lit(turn))
        heads = (
            now.groupBy("key")
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min_by("node", order("node")).alias("head"))
            .where("lo < hi").select("key", "head")
        )
        of_head = groups.select(F.col("node").alias("head"), F.col("component").alias("ch"))
        pairs = (
            now.join(heads, "key").where("node <> head").join(of_head, "head", "left")
            .where("component <> coalesce(ch, head)")
            .groupBy(F.col("node").alias("b")).agg(F.min_by("head", order("head")).alias("a"))
        )
        pairs = materialize(pairs.select("a", "b"), "pairs")
        links = materialize(verified(pairs), "stars")
        found = links.count()
        if found:
            groups = _merged(groups, links)
        met = found > WORTH * pairs.count()
    return groups


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs (doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id that verified links reach, itself included, and
    ``kept`` says that it is the document's own. Null, empty and blank texts have an empty set and
    are linked with nothing. A row without a doc_id takes no part: no component, and kept.
    Repeated rows give repeated rows. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select("doc_id", utf8().alias("text"))
    sketched = materialize(
        arrow_map(docs, _sketches(words, bands, rows), "doc_id long, n long, node long, keys array<long>, marks binary"),
        "sketches",
    )
    named = sketched.where("doc_id IS NOT NULL AND node IS NOT NULL")
    classes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    reps = materialize(named.join(classes, ["node", "doc_id"]).select("node", "doc_id", "keys", "marks"), "classes")

    placed = reps.select("node", F.explode("keys").alias("key")).distinct()
    several = placed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    shared = materialize(placed.join(several.select("key"), "key", "left_semi"), "buckets")

    wanted = shared.select("node").distinct().join(reps.select("node", "doc_id"), "node").select("doc_id").distinct()
    sets = materialize(
        arrow_map(docs.join(wanted, "doc_id", "left_semi").select("text"), _sets(words), "node long, shingles binary"),
        "sets",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        return arrow_map(
            _with_both(pairs, sets, "shingles", "sx", "sy"), _similar(percent), "a long, b long"
        )

    groups = _by_stars(shared, verified)

    final = _merged(groups, _across(shared, groups, reps, sets, percent, bands * rows))

    # Classes are named by their hash: give each component its smallest document.
    named_sets = classes.join(final, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = named_sets.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = named_sets.join(smallest, "component").select("node", "component_id")
    return sketched.join(of_node, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` per component of near-duplicates, with all columns: that of the smallest (doc_id, text hash).

    Rows take part by doc_id and text together, so one doc_id on different texts loses none of them, and rows
    without a doc_id (after all others) are compared like the rest. Of rows equal in both any one stays; empty sets are
    linked with nothing.
    """
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    of_row = near_duplicates(marked.select(F.col("__row").alias("doc_id"), "text"), **options).select(
        F.col("doc_id").alias("__row"), "component_id"
    )
    ids = marked.select("__row", "doc_id").distinct()
    first = of_row.distinct().join(ids, "__row").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    )
    kept = first.select("first.__row").distinct()
    return marked.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
