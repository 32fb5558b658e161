"""Edge index, reverse edges, degrees, super nodes and adjacency."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.operators.ids import with_row_index
from hetgraph.runtime import materialize

SUPER_NODE_DEGREE = 10_000


def edge_index(edges: DataFrame, src_col: str = "src", dst_col: str = "dst") -> DataFrame:
    """Any two columns as ``src`` and ``dst``."""
    return edges.select(F.col(src_col).alias("src"), F.col(dst_col).alias("dst"))


def _swapped(edges: DataFrame) -> list[Column]:
    swapped = {
        "src_type": F.col("dst_type"),
        "rel": F.concat(F.lit("rev_"), F.col("rel")),
        "dst_type": F.col("src_type"),
        "src": F.col("dst"),
        "dst": F.col("src"),
    }
    return [swapped.get(c, F.col(c)).alias(c) for c in edges.columns]


def reverse_edges(edges: DataFrame) -> DataFrame:
    """Swap the ends and their types; the relation gets the prefix ``rev_``."""
    return edges.select(*_swapped(edges))


def with_reverse(edges: DataFrame) -> DataFrame:
    """Both directions in one table, from one scan of the edges."""
    plain = F.struct(*edges.columns)
    return edges.select(F.inline(F.array(plain, F.struct(*_swapped(edges)))))


def degrees(edges: DataFrame, direction: str = "out", by: tuple[str, ...] = ()) -> DataFrame:
    """Edges per node; parallel edges count, a node without edges is absent.

    ``out`` and ``in`` give ``node_id, degree``. Any other direction gives ``node_id,
    out_degree, in_degree, degree`` in one aggregation over both ends, so no outer join.
    ``by`` adds grouping columns, for example the edge type.
    """
    if direction in ("out", "in"):
        end = "src" if direction == "out" else "dst"
        return edges.groupBy(*by, F.col(end).alias("node_id")).agg(F.count(F.lit(1)).alias("degree"))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = edges.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("src").alias("node_id"), one.alias("o"), zero.alias("i")),
                F.struct(F.col("dst").alias("node_id"), zero.alias("o"), one.alias("i")),
            )
        ),
    )
    return (
        ends.groupBy(*by, "node_id")
        .agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
        .withColumn("degree", F.col("out_degree") + F.col("in_degree"))
    )


def super_nodes(edges: DataFrame, threshold: int = SUPER_NODE_DEGREE, by: tuple[str, ...] = ()) -> DataFrame:
    """Nodes whose total degree is strictly above ``threshold``."""
    return degrees(edges, "both", by).where(F.col("degree") > threshold)


class Adjacency(NamedTuple):
    """Edges laid out by their near end.

    ``links``: ``pos, near_type, rel, far_type, near, far``, with ``pos`` unique and dense;
    the links of one node and edge type are neighbours in ``pos``. ``heads``: one row
    ``near_type, rel, far_type, near, start, degree`` per node and edge type. A link is thus
    fetched by ``pos`` alone, which no node can make hot.

    A stored adjacency has two more columns, by which its files are kept: ``span`` of the links
    (``span_rows`` positions each) and ``slot`` of the heads (a hash of the node). Joins on
    them as well let Spark leave out all files but those of the nodes asked for.
    """

    links: DataFrame
    heads: DataFrame
    span_rows: int | None = None
    slots: int | None = None


def span_of(pos: str | Column, span_rows: int) -> Column:
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / span_rows).cast("long")


def slot_of(near_type: str, near: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(near_type, near), F.lit(slots)).cast("long")


def build_adjacency(edges: DataFrame, direction: str = "out") -> Adjacency:
    """Lay the edges out by source (``out``) or by target (``in``). Parallel edges stay apart.

    The edges are written before they are sorted: the place of a row in its file tells equal rows apart, also in a task that runs
    again, and what gives the edges is not run once more for the bounds of the sort.
    """
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    ends = edges.select(
        F.col(f"{near}_type").alias("near_type"),
        "rel",
        F.col(f"{far}_type").alias("far_type"),
        F.col(near).alias("near"),
        F.col(far).alias("far"),
    )
    # The id comes first: it tells rows apart in one comparison of longs.
    group = ["near", "near_type", "rel", "far_type"]
    unique = materialize(ends, "ends").withColumn("copy", F.monotonically_increasing_id())
    links = with_row_index(unique, [*group, "far", "copy"], "pos").drop("copy")
    heads = links.groupBy(*group).agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("degree"))
    return Adjacency(links, heads)


def adjacency_lists(adjacency: Adjacency, width: int = 1024) -> DataFrame:
    """Neighbour lists in blocks of at most ``width``, so a super node is many rows, not one.

    The blocks are collected one after the other over sorted rows (see ``runtime.tune``): a task's memory holds one list and a sort.
    """
    # The id comes first, as in ``build_adjacency``.
    group = ["near", "near_type", "rel", "far_type"]
    placed = adjacency.links.join(adjacency.heads, group).withColumn(
        "block", F.floor((F.col("pos") - F.col("start")) / width).cast("long")
    )
    lists = placed.groupBy(*group, "block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "far"))), lambda x: x["far"]).alias("neighbors")
    )
    return lists.select("near_type", "rel", "far_type", "near", "block", "neighbors")
