"""Dense ids, edge id rewriting and the checks around them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hetgraph.runtime import materialize

# monotonically_increasing_id() keeps the row's place inside its partition in the low 33 bits.
_LOCAL_BITS = 33


class _Sorted(NamedTuple):
    rows: DataFrame  # the sorted rows with ``__part`` and ``__place``
    sizes: DataFrame  # one row per sort partition: ``__part``, ``__start``
    total: int | float


def _sorted_parts(df: DataFrame, keys: Sequence[str], weight: Column) -> _Sorted:
    """Range-sort, write once, and find what each sort partition starts from.

    Only the per-partition sums of ``weight`` come to the driver: as many numbers as the sort
    has partitions, however many rows there are. The sorted rows are files by then, so a lost
    executor cannot move a boundary.
    """
    stored = materialize(df.orderBy(*keys).withColumn("__mark", F.monotonically_increasing_id()), "sorted")
    rows = stored.select(
        *df.columns,
        F.shiftright("__mark", _LOCAL_BITS).alias("__part"),
        F.col("__mark").bitwiseAND((1 << _LOCAL_BITS) - 1).alias("__place"),
    )
    sums = sorted((r["__part"], r["w"]) for r in rows.groupBy("__part").agg(F.sum(weight).alias("w")).collect())
    starts = [0, *accumulate(w for _, w in sums)]
    sizes = df.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(sums, starts)], "__part long, __start long"
    )
    return _Sorted(rows, sizes, starts[-1])


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str],
    index: str,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Dense 0-based position in the order of ``(group_by, order_by)``, restarting per group.

    Equals ``row_number() - 1`` but has no task that holds a whole group: one range sort
    spreads the rows and each row keeps its place inside its range. Rows that tie on the full
    key must be told apart by the caller (see ``number_copies``), or their common range
    cannot be split. The ``group_by`` columns must not be null.
    """
    parts = _sorted_parts(df, [*group_by, *order_by], F.lit(1))
    placed = parts.rows.join(F.broadcast(parts.sizes), "__part").select(
        *df.columns, (F.col("__start") + F.col("__place")).alias(index)
    )
    if not group_by:
        return placed
    heads = placed.groupBy(*group_by).agg(F.min(index).alias("__head"))
    return placed.join(heads, list(group_by)).select(*df.columns, (F.col(index) - F.col("__head")).alias(index))


def with_running_total(df: DataFrame, order_by: Sequence[str], weight: str, before: str) -> tuple[DataFrame, int]:
    """Sum of the whole-number ``weight`` over all earlier rows, and the sum over all rows.

    The running sum is taken inside each sort partition and shifted by what the earlier
    partitions hold.
    """
    parts = _sorted_parts(df, order_by, F.col(weight))
    inside = F.sum(weight).over(
        W.partitionBy("__part").orderBy("__place").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    summed = parts.rows.withColumn("__sum", inside - F.col(weight)).join(F.broadcast(parts.sizes), "__part")
    return summed.select(*df.columns, (F.col("__start") + F.col("__sum")).alias(before)), parts.total


def number_copies(df: DataFrame, by: Sequence[str], copy: str = "copy", chunk: int = 65_536) -> DataFrame:
    """Keep the columns ``by`` and number equal rows 1..m, so that every row becomes unique.

    Equal rows are counted first (combined on the map side) and then laid out again. Groups
    of more than ``chunk`` copies are laid out in pieces that are spread over the cluster.
    """
    by = list(by)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__m"))
    few = counts.where(F.col("__m") <= chunk).select(
        *by, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__m"))).alias(copy)
    )
    last_piece = F.floor((F.col("__m") - 1) / chunk).cast("long")
    many = (
        counts.where(F.col("__m") > chunk)
        .withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
        .repartition(*by, "__piece")
        .select(
            *by,
            F.explode(
                F.sequence(
                    F.col("__piece") * chunk + 1,
                    F.least((F.col("__piece") + 1) * chunk, F.col("__m")),
                )
            ).alias(copy),
        )
    )
    return few.unionByName(many)


def type_order(node_types: Sequence[str], col: str = "node_type") -> Column:
    """Place of the type in the configured list; null for a type that is not in it."""
    order = F.lit(None).cast("int")
    for i, t in reversed(list(enumerate(node_types))):
        order = F.when(F.col(col) == t, F.lit(i)).otherwise(order)
    return order


def distinct_nodes(nodes: DataFrame) -> DataFrame:
    """Distinct non-null ids per type."""
    return nodes.where("node_id IS NOT NULL").select("node_type", "node_id").distinct()


def assign_global_ids(nodes: DataFrame, node_types: Sequence[str]) -> DataFrame:
    """``(node_type, node_id, global_id)``: one dense id space, types in the given order.

    Ids are longs. Null business ids get none, since no edge can refer to them.
    """
    unique = distinct_nodes(nodes).withColumn("__type", type_order(node_types))
    return with_row_index(unique.where("__type IS NOT NULL"), ["__type", "node_id"], "global_id").select(
        "node_type", "node_id", "global_id"
    )


def id_ranges(id_map: DataFrame) -> DataFrame:
    """First and last global id and the number of ids per type."""
    return id_map.groupBy("node_type").agg(
        F.min("global_id").alias("start_id"),
        F.max("global_id").alias("end_id"),
        F.count(F.lit(1)).alias("num_ids"),
    )


def _end_map(id_map: DataFrame, end: str) -> DataFrame:
    return id_map.select(
        F.col("node_type").alias(f"{end}_type"),
        F.col("node_id").alias(end),
        F.col("global_id").alias(f"{end}_gid"),
    )


def rewrite_edges(edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """Replace both ends of every edge by global ids; an edge with an unknown end is dropped."""
    joined = edges.join(_end_map(id_map, "src"), ["src_type", "src"]).join(
        _end_map(id_map, "dst"), ["dst_type", "dst"]
    )
    kept = [c for c in edges.columns if c not in ("src", "dst")]
    return joined.select(
        *[c for c in kept if c in ("src_type", "rel", "dst_type")],
        F.col("src_gid").alias("src"),
        F.col("dst_gid").alias("dst"),
        *[c for c in kept if c not in ("src_type", "rel", "dst_type")],
    )


def dangling_edges(edges: DataFrame, id_map: DataFrame) -> DataFrame:
    """Edges that ``rewrite_edges`` drops, counted per edge type and missing end."""
    known = id_map.select("node_type", "node_id")
    flagged = edges
    for end in ("src", "dst"):
        flag = known.select(
            F.col("node_type").alias(f"{end}_type"),
            F.col("node_id").alias(end),
            F.lit(True).alias(f"__{end}_known"),
        )
        flagged = flagged.join(flag, [f"{end}_type", end], "left")
    no_src, no_dst = F.col("__src_known").isNull(), F.col("__dst_known").isNull()
    return flagged.groupBy("src_type", "rel", "dst_type").agg(
        F.count_if(no_src).alias("unknown_src"),
        F.count_if(no_dst).alias("unknown_dst"),
        F.count_if(no_src | no_dst).alias("dropped"),
        F.count(F.lit(1)).alias("total"),
    )


def attach_global_id(nodes: DataFrame, id_map: DataFrame) -> DataFrame:
    """Nodes with their global id; duplicate node rows stay."""
    return nodes.join(id_map, ["node_type", "node_id"])


def relabel_subgraph(sub_nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the nodes of each subgraph and type 0..n-1 in id order.

    ``keys`` name the subgraph. A subgraph may hold any share of the rows, so the numbering is
    the ranged one and not a window per subgraph.
    """
    unique = sub_nodes.select(*keys, "node_type", "node_id").distinct()
    return with_row_index(unique, ["node_id"], "local_id", group_by=[*keys, "node_type"])


def relabel_edges(sub_edges: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges of each subgraph in local ids; a subgraph without edges gets a self loop per node."""
    keys = list(keys)
    out = sub_edges
    for end in ("src", "dst"):
        names = labels.select(
            *keys,
            F.col("node_type").alias(f"{end}_type"),
            F.col("node_id").alias(end),
            F.col("local_id").alias(f"__{end}"),
        )
        out = out.join(names, [*keys, f"{end}_type", end])
    out = out.select(
        *keys, "src_type", "rel", "dst_type", F.col("__src").alias("src"), F.col("__dst").alias("dst")
    )
    alone = labels.join(sub_edges.select(*keys).distinct(), keys, "left_anti")
    loops = alone.select(
        *keys,
        F.col("node_type").alias("src_type"),
        F.lit("self").alias("rel"),
        F.col("node_type").alias("dst_type"),
        F.col("local_id").alias("src"),
        F.col("local_id").alias("dst"),
    )
    return out.unionByName(loops)
