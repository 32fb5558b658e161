"""Nearest neighbours by inner product with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is put into one of its leaves. A query walks the tree
best bin first: a priority queue holds the nodes met so far by the distance of their centre, the
nearest is opened next, and the leaves come out in the order in which they are to be visited. How many leaves
a query visits is calibrated: for some queries the true neighbours are found among all rows, and visits are widened until
the target recall is reached on them.

For inner products the vectors get one more coordinate that makes them equally long (Bachrach et
al., 2014), so the nearest vector is the one with the largest product. Small leaves that follow each other in the
tree share a bin: a query is sent once to a bin, whichever of its leaves it visits, and meets all rows of the bin. Bins are
cut into blocks of rows, visits into blocks of queries, and the blocks of a bin are multiplied: a leaf may hold any share of
the rows. The first few bins give each query a score that later bins have to reach, so these send few rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, list_array
from hetgraph.runtime import materialize

SAMPLE, BRANCHES, LEAF_ROWS, STEPS, SEED = 20_000, 16, 200, 8, 5
CALIBRATION, RECALL, FIRST = 200, 0.97, 3
BLOCK_ROWS, BLOCK_QUERIES = 1_024, 256
_CLOSE = 1e-9


class Tree(NamedTuple):
    """Inner nodes have their children's centres and numbers; a leaf is -1 - its number."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``x``, going down to the nearest centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.leaves > 1 else []
        while todo:
            node, rows = todo.pop()
            c = self.centres[node]
            near = ((c * c).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
            for k, child in enumerate(self.children[node]):
                below = rows[near == k]
                if child < 0:
                    out[below] = -1 - child
                elif len(below):
                    todo.append((child, below))
        return out

    def visits(self, q: np.ndarray, most: int, rows: np.ndarray | None = None, wanted: int = 0) -> list[int]:
        """The first ``most`` leaves of one query, best bin first, and further ones until they hold ``wanted`` rows.

        ``rows`` says how many rows each leaf holds.
        """
        if self.leaves <= 1:
            return [0][:most]
        queue, out, met = [(0.0, 0)], [], 0
        while queue and (len(out) < most or met < wanted):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                met += int(rows[out[-1]]) if rows is not None else 0
                continue
            d = ((self.centres[node] - q) ** 2).sum(axis=1)
            for item in zip(d.tolist(), self.children[node]):
                heapq.heappush(queue, item)
        return out


def grow(sample: np.ndarray, rows: int, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split the sample by k-means until a leaf stands for about ``leaf_rows`` of ``rows``."""
    rng, centres, children, leaves = np.random.default_rng(SEED), [], [], 0
    each = rows / max(len(sample), 1)

    def split(x: np.ndarray) -> int:
        nonlocal leaves
        c = None
        if len(x) * each > leaf_rows and len(x) >= 2 * branches:
            c = x[rng.choice(len(x), branches, replace=False)]
            for _ in range(STEPS):
                near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
                n = np.bincount(near, minlength=len(c))
                c = np.stack([x[near == k].mean(axis=0) for k in np.flatnonzero(n)])
            near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
            kinds = np.unique(near)
        if c is None or len(kinds) < 2:
            leaves += 1
            return -leaves
        node = len(centres)
        centres.append(c[kinds])
        children.append([])
        for k in kinds:
            child = split(x[near == k])
            children[node].append(child)
        return node

    split(sample)
    return Tree(centres, children, leaves)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _even_length(x: np.ndarray, longest: float) -> np.ndarray:
    """With the coordinate that makes all rows equally long."""
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))[:, None]])


def _direction(q: np.ndarray) -> np.ndarray:
    return np.hstack([q / np.sqrt((q * q).sum(axis=1))[:, None], np.zeros((len(q), 1))])


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up coordinate by coordinate: the same whatever stands around."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def _best(q_ids, q, x_ids, x, k, least) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its ``k`` best rows of a block that reach ``least``: places and scores."""
    rough = q @ x.T
    rough[q_ids[:, None] == x_ids[None, :]] = -np.inf
    floor = least
    if len(x) > k:
        floor = np.maximum(least, np.partition(rough, len(x) - k, axis=1)[:, len(x) - k])
    slack = _CLOSE * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))
    i, j = np.nonzero((rough >= (floor - slack)[:, None]) & np.isfinite(rough))
    score = _products(q[i], x[j])
    order = np.lexsort((x_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i)
    keep = (np.arange(len(i)) - first < k) & (score >= least[i])
    return i[keep], j[keep], score[keep]


def vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of the rows that take part, one per id.

    Null ids, null and zero vectors, those with null or non-finite components and those that are not as long as
    most are left out. Of different vectors with one id the smallest stays.
    """
    x = F.col("embedding").cast("array<double>")
    good = table.select("vec_id", x.alias("embedding")).where(
        "vec_id IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity'))"
        " AND exists(embedding, v -> v <> 0)"
    )
    one = good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    usual = one.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return materialize(one.where(F.size("embedding") == (usual["d"] if usual else 0)), "vectors")


def _brute(ids: np.ndarray, q: np.ndarray, tree: Tree, longest: float, k: int):
    """The true neighbours of a few queries within one task, with their leaves."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        kept = None
        for b in batches:
            x_ids, x = b["vec_id"].to_numpy(), _matrix(b["embedding"])
            i, j, score = _best(ids, q, x_ids, x, k, np.full(len(q), -np.inf))
            leaf = tree.leaf_of(_even_length(x[j], longest))
            new = np.stack([i, x_ids[j], leaf]), score
            if kept is not None:
                new = np.hstack([kept[0], new[0]]), np.concatenate([kept[1], score])
            order = np.lexsort((new[0][1], -new[1], new[0][0]))
            rows, score = new[0][:, order], new[1][order]
            few = np.arange(len(score)) - np.searchsorted(rows[0], rows[0]) < k
            kept = rows[:, few], score[few]
        if kept is not None:
            (i, vec, leaf), score = kept
            yield {"query_id": ids[i], "vec_id": vec, "leaf": leaf, "score": score}

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrate(data: DataFrame, queries: DataFrame, tree: Tree, longest: float, k: int, recall: float) -> int:
    """How many leaves to visit so that ``recall`` is reached on some of the queries, against all rows."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    ids, q = np.array([r["vec_id"] for r in some], np.int64), np.array([r["embedding"] for r in some])
    schema = "query_id long, vec_id long, leaf long, score double"
    true = _ranked(arrow_map(data.select("vec_id", "embedding"), _brute(ids, q, tree, longest, k), schema), k)
    leaves = {}
    for r in true.collect():
        leaves.setdefault(r["query_id"], []).append(r["leaf"])
    places = []
    for i, one in zip(ids.tolist(), _direction(q)):
        at = {leaf: n for n, leaf in enumerate(tree.visits(one, tree.leaves))}
        places += [at[leaf] + 1 for leaf in leaves.get(i, [])]
    if not places:
        return 1
    return int(np.sort(places)[int(np.ceil(recall * len(places))) - 1])


def _placed(tree: Tree, longest: float):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            leaf = tree.leaf_of(_even_length(_matrix(b["embedding"]), longest))
            yield {"vec_id": b["vec_id"], "embedding": b["embedding"], "leaf": leaf}

    return run


def bins_of(rows: np.ndarray, size: int = BLOCK_ROWS) -> np.ndarray:
    """The bin of each leaf: leaves that follow each other share one as long as they hold at most ``size`` rows."""
    out, held, at = np.zeros(len(rows), np.int64), 0, 0
    for leaf, n in enumerate(rows.tolist()):
        if held and held + n > size:
            held, at = 0, at + 1
        held += n
        out[leaf] = at
    return out


def _visited(tree: Tree, most: int, rows: np.ndarray, bins: np.ndarray, wanted: int):
    """The bins of each query in the order in which their first leaf is visited."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = []
            for one in _direction(_matrix(b["embedding"])):
                met = bins[tree.visits(one, most, rows, wanted)]
                found.append(met[np.sort(np.unique(met, return_index=True)[1])])
            yield {"vec_id": b["vec_id"], "embedding": b["embedding"], "bins": list_array(found, "int64")}

    return run


def _multiply(k: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for rows, queries in zip(b["rows"], b["queries"]):
                rows, queries = rows.values, queries.values
                x_ids, x = rows.field("vec_id").to_numpy(), _matrix(rows.field("embedding"))
                q_ids, q = queries.field("vec_id").to_numpy(), _matrix(queries.field("embedding"))
                i, j, score = _best(q_ids, q, x_ids, x, k, queries.field("least").to_numpy(zero_copy_only=False))
                yield {"query_id": q_ids[i], "vec_id": x_ids[j], "score": score}

    return run


def _pieces(key: str, count: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.ceil(count / size))


def _visit(bins: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Hits of ``visits (bin, vec_id, embedding, least)`` in the blocks of ``bins (bin, rows)``."""
    spark = bins.sparkSession
    counted = visits.join(visits.groupBy("bin").agg(F.count("*").alias("n")), "bin")
    queries = counted.groupBy("bin", _pieces("vec_id", F.col("n"), BLOCK_QUERIES).alias("piece")).agg(
        F.collect_list(F.struct("vec_id", "embedding", "least")).alias("queries")
    )
    blocks = bins.join(queries, "bin").select("rows", "queries")
    # A row holds two blocks, so few rows at a time go to Python.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, 8)
    try:
        return materialize(arrow_map(blocks, _multiply(k), "query_id long, vec_id long, score double"), "hits")
    finally:
        spark.conf.set(name, usual)


def search(table: DataFrame, queries: str, k: int = 20, recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row that ``queries`` selects.

    ``queries`` is a condition on ``vec_id`` of ``table (vec_id, embedding, ...)``. A query's own id is no candidate; ties
    go to the smaller id; where there are fewer candidates than ``k``, all of them that visited leaves hold come. What takes
    no part is said at ``vectors``. Other columns are ignored; no rows or no queries give no rows.
    """
    data = vectors(table)
    asked = data.where(queries)
    size = data.agg(
        F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)).alias("m")
    ).first()
    spark = data.sparkSession
    if not size["n"] or asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(np.sqrt(size["m"])) * (1 + 1e-12)
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
    tree = grow(_even_length(np.array([r["embedding"] for r in sample]), longest), size["n"])
    del sample
    most = calibrate(data, asked, tree, longest, k, recall)

    schema = "vec_id long, embedding array<double>"
    placed = arrow_map(data, _placed(tree, longest), f"{schema}, leaf long")
    placed = materialize(placed, "placed")
    # One number per leaf of a tree whose size is bounded by its sample.
    held = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        held[r["leaf"]] = r["n"]
    bin_of = bins_of(held)
    in_bin = np.bincount(bin_of, weights=held).astype(np.int64)
    named = spark.createDataFrame(
        [(i, int(k), int(in_bin[k])) for i, k in enumerate(bin_of)], "leaf long, bin long, n long"
    )
    bins = materialize(
        placed.join(F.broadcast(named), "leaf")
        .groupBy("bin", _pieces("vec_id", F.col("n"), BLOCK_ROWS).alias("piece"))
        .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("rows")),
        "bins",
    )
    # A query's own row may be among those of its leaves.
    visits = arrow_map(asked, _visited(tree, most, held, bin_of, k + 1), f"{schema}, bins array<long>")
    visits = materialize(visits, "visits")
    walk = visits.select("vec_id", "embedding", F.posexplode("bins").alias("turn", "bin"))

    start = walk.where(F.col("turn") < FIRST).withColumn("least", F.lit(float("-inf")))
    near = materialize(_ranked(_visit(bins, start, k), k), "near")
    least = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    more = walk.where(F.col("turn") >= FIRST).join(least, "vec_id", "left").withColumn(
        "least", F.coalesce("least", F.lit(float("-inf")))
    )
    far = _visit(bins, more, k)
    both = near.select("query_id", "vec_id", "score").unionByName(far)
    return _ranked(both, k).select("query_id", "rank", "vec_id", "score")
