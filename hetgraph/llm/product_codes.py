"""Codes for vectors: k-means per part of the vector, assigned through cover trees.

A vector becomes whole numbers and is cut into parts; every part has a codebook, improved in rounds of
assignment and averaging (Lloyd). All arithmetic is on whole numbers, so results do not depend on how rows
are dealt.

The rows of each Spark partition are cut into chunks, and every chunk keeps one cover tree per part: a
node is a centre with the radius that holds its rows, its children lie within half of that radius of their own
centres, and the rows below a node are a run in the tree's order, so that their sum is the difference of two
cumulative sums. A round walks the trees level by level. If the codebook entry nearest to a node's
centre beats the next one by more than twice the radius, the triangle inequality gives it all rows of the node at
once; the rows of the other nodes go on to the children, and only those at the ends are compared one by one. A group
of copies of any size is one node of radius zero. What leaves a task is one sum and one count per codebook entry.

The trees are written once and read again in every round. The driver holds the codebooks, whose size is a parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map
from hetgraph.runtime import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows of one set of trees, rows below which a node is not divided, and candidates tried at a time.
CHUNK, LEAF, TRIED = 8_192, 24, 64
#: Components from here on (in absolute value) have squared distances that a long cannot hold.
LIMIT = 2.0**14
#: Up to here sums of products are exact in doubles.
_EXACT = 2.0**53
_SLACK = 1e-9


class Tree(NamedTuple):
    """Per node its centre (a row) and radius, its run ``start:end`` in tree order, and its children.

    The rows ``start:own`` lie in no child. The children of a node are neighbours, ``child`` is the first.
    """

    centre: np.ndarray
    start: np.ndarray
    own: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray
    radius: np.ndarray


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``c``: whole numbers, exact."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    kind = np.float64 if 4.0 * float(most) ** 2 * max(x.shape[1], 1) < _EXACT else np.int64
    x, c = x.astype(kind, copy=False), c.astype(kind, copy=False)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]


def _cover(x: np.ndarray, centre: int, within: float) -> tuple[np.ndarray, list[int]]:
    """The child of each row and the children's centres, which are further apart than ``within``.

    The first child is around ``centre``. Rows get -1 where a further round of candidates would gather hardly more
    than the candidates themselves.
    """
    limit, child = within * within, np.full(len(x), -1)
    child[squared(x, x[centre : centre + 1])[:, 0] <= limit] = 0
    centres = [centre]
    while True:
        left = np.flatnonzero(child < 0)
        tried = left[:: max(1, len(left) // TRIED)][:TRIED]
        if not len(left):
            break
        among = squared(x[tried], x[tried]) <= limit
        chosen: list[int] = []
        for i in range(len(tried)):
            if not among[i, chosen].any():
                chosen.append(i)
        d = squared(x[left], x[tried[chosen]])
        near = d.argmin(axis=1)
        taken = d[np.arange(len(left)), near] <= limit
        sizes = np.bincount(near[taken], minlength=len(chosen))
        good = np.flatnonzero(sizes >= LEAF)
        if taken.sum() < 4 * len(chosen) or not len(good):
            break
        names = np.full(len(chosen), -1)
        names[good] = np.arange(len(centres), len(centres) + len(good))
        child[left[taken]] = names[near[taken]]
        centres += tried[np.array(chosen)[good]].tolist()
    if (child == 0).sum() < LEAF:
        child[child == 0] = -1
    return child, centres


def grow(x: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The cover tree of the rows of ``x``, and the rows in its order."""
    order = np.arange(len(x))
    todo, nodes, at = [(0, len(x), 0)], [], 0
    while at < len(todo):
        start, end, centre = todo[at]
        at += 1
        mine = x[order[start:end]]
        far = float(squared(mine, x[centre : centre + 1]).max())
        own, first = end, len(todo)
        if far and end - start > LEAF:
            # Half of the smallest power of two that holds the node: the next level.
            place = int(np.flatnonzero(order[start:end] == centre)[0])
            child, centres = _cover(mine, place, 2.0 ** np.ceil(np.log2(np.sqrt(far))) / 2)
            rows = order[start:end]
            heads = rows[centres]
            sizes = np.bincount(child + 1, minlength=len(centres) + 1).tolist()
            order[start:end] = rows[np.argsort(child, kind="stable")]
            own = edge = start + sizes[0]
            for n, head in zip(sizes[1:], heads.tolist()):
                if n:
                    todo.append((edge, edge + n, head))
                    edge += n
        nodes.append((centre, start, own, end, first, len(todo) - first, np.sqrt(far)))
    columns = np.array(nodes, np.float64).T
    where = np.empty(len(x), np.int64)
    where[order] = np.arange(len(x))
    whole = [c.astype(np.int64) for c in columns[:6]]
    # From here on rows are named by their place in the tree's order.
    return Tree(where[whole[0]], *whole[1:], columns[6]), order


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the runs ``start:end``."""
    n = end - start
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())


def walk(tree: Tree, x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest entries of ``book`` for ``x`` (in tree order), ties to the lower one.

    ``start, end, entry`` of the runs that are decided as a whole, ``row, entry`` of the rows that are not.
    """
    # Of equal entries only the first can be the nearest; the others would leave every node open.
    firsts = np.sort(np.unique(book, axis=0, return_index=True)[1])
    book = book[firsts]
    runs, singles, level = [], [], np.zeros(1, np.int64)
    while len(level):
        d = squared(x[tree.centre[level]], book)
        best = d.argmin(axis=1)
        root = np.sqrt(d.astype(np.float64))
        nearest, r = root[np.arange(len(level)), best], tree.radius[level]
        bound = nearest + 2 * r + _SLACK * (1 + nearest + r)
        sure = ((root <= bound[:, None]).sum(axis=1) == 1) | (r == 0)
        runs.append(np.stack([tree.start[level[sure]], tree.end[level[sure]], best[sure]]))
        open_ = level[~sure]
        singles.append(_ranges(tree.start[open_], tree.own[open_]))
        level = _ranges(tree.child[open_], tree.child[open_] + tree.children[open_])
    start, end, entry = np.hstack(runs)
    rows = np.concatenate(singles)
    single = [squared(x[rows[i : i + 4096]], book).argmin(axis=1) for i in range(0, len(rows), 4096)]
    return start, end, firsts[entry], rows, firsts[np.concatenate(single)] if single else rows


def _sums(tree: Tree, x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the rows of every entry."""
    start, end, entry, rows, single = walk(tree, x, book)
    upto = np.zeros((len(x) + 1, x.shape[1]), np.int64)
    np.cumsum(x, axis=0, out=upto[1:])
    total, n = np.zeros((len(book), x.shape[1]), np.int64), np.zeros(len(book), np.int64)
    np.add.at(total, entry, upto[end] - upto[start])
    np.add.at(n, entry, end - start)
    np.add.at(total, single, x[rows])
    return total, n + np.bincount(single, minlength=len(book))


def _edges(d: int, parts: int) -> list[int]:
    """Where the parts of ``d`` components begin and end."""
    return [i * d // parts for i in range(parts + 1)]


def quantised(values: np.ndarray) -> np.ndarray:
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)


def _pack(a: np.ndarray) -> bytes:
    """With the smallest of two widths in front."""
    small = np.abs(a).max(initial=0) < 2**15
    return (b"2" + a.astype("<i2").tobytes()) if small else (b"4" + a.astype("<i4").tobytes())


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<i2" if b[:1] == b"2" else "<i4", offset=1).astype(np.int64)


def _plant(parts: int, d: int):
    """Chunks of rows with one tree per part."""
    edges = _edges(d, parts)

    def chunk(ids: pa.Array, labels: pa.Array, x: np.ndarray) -> dict:
        trees = []
        for a, b in zip(edges, edges[1:]):
            tree, order = grow(x[:, a:b])
            trees.append({
                "points": _pack(x[order, a:b].ravel()), "places": _pack(order),
                "nodes": _pack(np.stack(tree[:6]).ravel()), "radii": tree.radius.tobytes(),
            })
        one = pa.array([0, len(ids)], pa.int32())
        return {"ids": pa.ListArray.from_arrays(one, ids), "labels": pa.ListArray.from_arrays(one, labels), "trees": [trees]}

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held, n = [], 0
        for b in batches:
            x = quantised(b["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(len(b["vec_id"]), d))
            held.append((b["vec_id"], b["label"], x))
            n += len(x)
            if n >= CHUNK:
                yield from cut(held)
                held, n = [], 0
        if n:
            yield from cut(held)

    def cut(held: list) -> Iterator[dict]:
        ids, labels = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
        x = np.concatenate([h[2] for h in held])
        for at in range(0, len(x), CHUNK):
            yield chunk(ids[at : at + CHUNK], labels[at : at + CHUNK], x[at : at + CHUNK])

    return run


_TREES = "trees array<struct<points binary, places binary, nodes binary, radii binary>>"


def _tree(stored) -> tuple[Tree, np.ndarray]:
    """The tree of a stored part and its rows in tree order, one row of numbers per node or row."""
    nodes = _unpack(stored["nodes"]).reshape(6, -1)
    places = _unpack(stored["places"])
    return Tree(*nodes, np.frombuffer(stored["radii"])), places


def _step(books: list[np.ndarray]):
    """Sums and counts of one round, added up over all chunks of the task."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        totals = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for b in batches:
            for trees in b["trees"]:
                for p, stored in enumerate(trees.as_py()):
                    tree, places = _tree(stored)
                    x = _unpack(stored["points"]).reshape(len(places), -1)
                    total, n = _sums(tree, x, books[p])
                    totals[p] += total
                    counts[p] += n
        for p in range(len(books)):
            used = np.flatnonzero(counts[p])
            yield {
                "part": np.full(len(used), p), "entry": used, "n": counts[p][used],
                "total": pa.array(list(totals[p][used]), pa.list_(pa.int64())),
            }

    return run


def _code(books: list[np.ndarray]):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for ids, labels, trees in zip(b["ids"], b["labels"], b["trees"]):
                codes = np.zeros((len(ids), len(books)), np.int64)
                error = np.zeros(len(ids), np.int64)
                for p, stored in enumerate(trees.as_py()):
                    tree, places = _tree(stored)
                    x = _unpack(stored["points"]).reshape(len(places), -1)
                    start, end, entry, rows, single = walk(tree, x, books[p])
                    found = np.zeros(len(x), np.int64)
                    found[_ranges(start, end)] = np.repeat(entry, end - start)
                    found[rows] = single
                    away = x - books[p][found]
                    codes[places, p] = found
                    error[places] += (away * away).sum(axis=1)
                code = ["".join(f"{i:02x}" for i in row) for row in codes.tolist()]
                yield {"vec_id": ids.values, "label": labels.values, "code": code, "error": error}

    return run


def kept_vectors(table: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, embedding, label)`` of the rows that take part, and how long their vectors are."""
    good = table.select("vec_id", "embedding", "label").where(
        f"size(embedding) > 0 AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < {LIMIT}D)"
    )
    sizes = good.groupBy(F.size("embedding").alias("d")).count()
    usual = sizes.orderBy(F.desc("count"), "d").first()
    d = usual["d"] if usual else 0
    return good.where(F.size("embedding") == d), d


def _first_books(good: DataFrame, d: int, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids; at most ``entries`` rows come to the driver."""
    ids = [r[0] for r in good.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()]
    mine = F.col("vec_id").isin([i for i in ids if i is not None])
    if ids[-1] is None:
        mine = F.coalesce(mine, F.lit(False)) | F.col("vec_id").isNull()
    found = {r[0]: r[1] for r in good.where(mine).groupBy("vec_id").agg(F.min("embedding")).collect()}
    x = quantised(np.array([found[i] for i in ids]))
    edges = _edges(d, parts)
    return [x[:, a:b] for a, b in zip(edges, edges[1:])]


def compress(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of ``table (vec_id, embedding, label, ...)``, and the codebooks.

    Components become ``floor(1024 * x)``, vectors are cut into ``parts`` (as equal as their length allows). The first
    codebooks are the parts of the vectors with the ``entries`` smallest ids (of several with one id the smallest vector,
    a null id last); each round assigns every part to the nearest entry, ties to the lower one, and replaces entries by the
    floor of the mean. ``code`` has two hex digits per part, ``error`` is the final squared distance, ``label_error`` its sum
    over rows with the same label, nulls together.

    Left out are null and empty vectors, those with null or non-finite components or components of 16,384 and
    more (whose squared distances need not fit a long), and those that are not as long as most (of equally frequent
    lengths the smallest counts). Repeated rows give repeated rows. Other columns are ignored; an empty table gives no rows.
    """
    spark = table.sparkSession
    good, d = kept_vectors(table)
    kind = table.schema["label"].dataType.simpleString()
    result = f"vec_id long, code string, error long, label {kind}"
    if not d:
        empty = spark.createDataFrame([], result).withColumn("label_error", F.lit(0).cast("long"))
        return empty.select("vec_id", "code", "error", "label_error", F.lit("").alias("codebooks_sha256")), []
    books = _first_books(good, d, parts, entries)
    planted = arrow_map(
        good.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label"),
        _plant(parts, d),
        f"ids array<long>, labels array<{kind}>, {_TREES}",
    )
    planted = materialize(planted, "trees")
    # A row holds a chunk, so few rows at a time go to Python.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, 4)
    try:
        for _ in range(rounds):
            books = _improved(planted, books)
        schema = f"vec_id long, label {kind}, code string, error long"
        coded = materialize(arrow_map(planted, _code(books), schema), "codes")
    finally:
        spark.conf.set(name, usual)
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    per_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    out = coded.join(per_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(sha256(text.encode()).hexdigest()).alias("codebooks_sha256")
    )
    return out, books


def _improved(planted: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round; at most one row per codebook entry comes to the driver."""
    steps = arrow_map(planted.select("trees"), _step(books), "part int, entry int, n long, total array<long>")
    long = steps.select("part", "entry", "n", F.posexplode_outer("total").alias("at", "v"))
    sums = long.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    new = [b.copy() for b in books]
    for r in sums.collect():
        if r["at"] is not None:
            new[r["part"]][r["entry"], r["at"]] = r["v"] // r["n"]
    return new
