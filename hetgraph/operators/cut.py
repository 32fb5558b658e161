"""Node partitions that hold a quota of edge ends and cut few edges."""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.functions.hashing import hash52
from hetgraph.operators.ids import with_running_total
from hetgraph.operators.partition import balanced_map
from hetgraph.runtime import drop_tables, materialize, recorded

NODE = ["node_type", "node_id"]
KEY = ["far_type", "far_id"]
#: Neighbours in one list, about.
LISTED = 4_096


def _lists(edges: DataFrame, owner: DataFrame) -> DataFrame:
    """The neighbours of every node of the map, in lists: ``node_type, node_id, far_type, times, fars``.

    Every link is seen from both ends; links of a node with itself never cross a cut. The links are exchanged once, by node.
    Those of a node of more than ``LISTED`` are counted first, so that equal ones are one entry, and it has several lists.
    """

    def ends(a, b):
        return F.struct(*(F.col(c).alias(n) for c, n in zip((f"{a}_type", a, f"{b}_type", b), (*NODE, *KEY))))

    both = edges.select(F.inline(F.array(ends("src", "dst"), ends("dst", "src"))))
    both = both.where("node_type <> far_type OR node_id <> far_id")
    large = owner.where(F.col("weight") > LISTED).select(*NODE, F.ceil(F.col("weight") / LISTED).alias("pieces"))
    large = materialize(large, "cut-large")
    some = not large.isEmpty()
    # The id comes first: it tells rows apart in one comparison of longs.
    key, fars = ["node_id", "node_type", "far_type"], F.collect_list("far_id").alias("fars")
    few = both.join(large, NODE, "left_anti") if some else both
    few = few.repartition(*NODE).join(owner.where(F.col("weight") <= LISTED).select(*NODE), NODE, "left_semi")
    lists = few.groupBy(*key).agg(fars).select(*NODE, "far_type", F.lit(1).cast("long").alias("times"), "fars")
    if some:
        counted = both.join(large, NODE).groupBy(*NODE, *KEY, "pieces").agg(F.count(F.lit(1)).alias("times"))
        piece = F.pmod(F.xxhash64(*KEY), F.col("pieces")).alias("piece")
        lists = lists.unionByName(counted.groupBy(*key, "times", piece).agg(fars).drop("piece"))
    return lists


def _told(lists: DataFrame, changes: DataFrame) -> DataFrame:
    """What the neighbours of the nodes in ``changes (node_type, node_id, to, sign)`` see: links to a part, won or lost."""
    links = (F.col("times") * F.col("sign")).alias("links")
    return lists.join(changes, NODE).select(F.col("far_type").alias("node_type"), F.explode("fars").alias("node_id"), "to", links)


def _summed(rows: DataFrame) -> DataFrame:
    """Links per node and part; links are added up before they meet the node, which so has at most one row per part."""
    return rows.groupBy(*NODE, "to").agg(F.sum("links").alias("links")).where("links > 0")


def _tally(sums: DataFrame, owner: DataFrame) -> DataFrame:
    """Per node: its part, its links that stay inside, and the other part that most of its links lead to."""
    here = F.col("to") == F.col("partition_id")
    best = F.max(F.when(~here, F.struct("links", (-F.col("to")).alias("minus"))))
    return (
        sums.join(owner, NODE)
        .groupBy(*NODE, "partition_id", "weight")
        .agg(F.coalesce(F.sum(F.when(here, F.col("links"))), F.lit(0)).alias("inside"), best.alias("best"), F.sum("links").alias("all"))
        .select(*NODE, "partition_id", "weight", "inside", "all", (-F.col("best.minus")).alias("to"), F.col("best.links").alias("outside"))
    )


def _admitted(wishes: DataFrame, limits: DataFrame, key: list[str]) -> DataFrame:
    """Of the wishes for each ``key``, those with the largest gain per edge end that fit its ``limit``.

    One range sort over all wishes gives running totals; the wishes of a key begin where its smallest total is,
    so no task holds all wishes for one part.
    """
    ranked = wishes.withColumn("order", -F.col("gain") / F.col("weight"))
    summed = materialize(with_running_total(ranked, [*key, "order", *NODE], "weight", "before")[0], "cut-wishes")
    first = summed.groupBy(*key).agg(F.min("before").alias("first"))
    fits = F.col("before") - F.col("first") + F.col("weight") <= F.col("limit")
    return summed.join(first.join(limits, key), key).where(fits).select(*NODE, "from", F.col("to").alias("moved_to"))


def _loads(owner: DataFrame) -> DataFrame:
    return owner.groupBy("partition_id").agg(F.sum("weight").alias("load"))


def _moved(owner: DataFrame, moves: DataFrame) -> DataFrame:
    """The map after the moves; the same map again if there are none."""
    to = F.coalesce("moved_to", "partition_id").alias("partition_id")
    return materialize(owner.join(moves, NODE, "left").select(*NODE, "weight", to), "cut-map")


def cut_aware_map(
    edges: DataFrame, nodes: DataFrame, n: int, rounds: int = 8, slack: float = 0.05, seed: int = 42,
    start: DataFrame | None = None,
) -> DataFrame:
    """``node_type, node_id, weight, partition_id``: as ``balanced_map``, with fewer edges between parts.

    Starts from ``balanced_map``, which may be given as ``start``. In each round the nodes whose coin says so (a hash of round and node) ask for the part that holds most of their links, if that is more than
    where they are. Rounds take turns: in one, each part admits the best of them into what room it has; in the
    other, each pair of parts exchanges nodes of about the same number of edge ends both ways, which full parts can do
    as well. Nodes that move at the same time spoil each other's gains on dense graphs: a round after which the cut is
    not smaller is taken back, and the next asks half as many nodes. The quota is ``1 + slack`` times the mean of edge ends, or the fullest part of ``balanced_map`` if that is more.
    It always holds: admission counts no departures, and an exchange that comes out above it is taken back.
    When neither kind of round moves a node, the map stays.

    Links are added up by node and part once. After that only the neighbours of nodes that move are told, and a round costs one
    join of the neighbour lists with the moves and two aggregations of at most one row per node and part; room and loads are
    ``n`` rows, exchanges at most ``n * n``. Nulls and ends that are no node are not placed. Repeated node rows count once.
    """
    spark = edges.sparkSession
    owner = materialize(balanced_map(edges, nodes, n), "cut-map") if start is None else start
    lists = materialize(_lists(edges, owner), "cut-lists")
    held = _loads(owner).agg(F.sum("load").alias("total"), F.max("load").alias("most")).first()
    quota = max(floor((held.total or 0) * (1 + slack) / n), held.most or 0)
    parts = spark.range(n).select(F.col("id").cast("int").alias("to"))

    def crossing(tally):
        return tally.agg(F.sum(F.col("all") - F.col("inside"))).first()[0] or 0

    first = owner.select(*NODE, F.col("partition_id").alias("to"), F.lit(1).alias("sign"))
    sums = materialize(_summed(_told(lists, first)), "cut-sums")
    tally = materialize(_tally(sums, owner), "cut-tally")
    cut, share, idle = crossing(tally), 2, 0
    for turn in range(rounds):
        asking = tally.where(F.col("outside") > F.col("inside"))
        if asking.isEmpty():
            break
        coin = F.pmod(hash52(seed, turn, *map(F.col, NODE)), F.lit(share)) == 0
        wishes = asking.where(coin).select(
            *NODE, "weight", F.col("partition_id").alias("from"), "to", (F.col("outside") - F.col("inside")).alias("gain")
        )
        with recorded() as aside:
            if turn % 2 == 0:
                held = _loads(owner).withColumnRenamed("partition_id", "to")
                room = (F.lit(quota) - F.coalesce("load", F.lit(0))).alias("limit")
                moves = _admitted(wishes, parts.join(held, "to", "left").select("to", room), ["to"])
            else:
                flow = wishes.groupBy("from", "to").agg(F.sum("weight").alias("flow"))
                back = flow.select(F.col("from").alias("to"), F.col("to").alias("from"), F.col("flow").alias("back"))
                both = flow.join(back, ["from", "to"]).select("from", "to", F.least("flow", "back").alias("limit"))
                moves = _admitted(wishes, both, ["from", "to"])
            moves = materialize(moves, "cut-moves")
        idle = idle + 1 if moves.isEmpty() else 0
        if idle:
            drop_tables(spark, aside)
            if idle == 2:
                break
            continue
        with recorded() as new:
            after = _moved(owner, moves)
            lost, won = (F.struct(F.col(c).alias("to"), F.lit(sign).alias("sign")) for c, sign in (("from", -1), ("moved_to", 1)))
            told = _told(lists, moves.select(*NODE, F.inline(F.array(lost, won))))
            then = materialize(_summed(sums.unionByName(told)), "cut-sums")
            seen = materialize(_tally(then, after), "cut-tally")
        crossed = crossing(seen)
        if crossed < cut and (_loads(after).agg(F.max("load")).first()[0] or 0) <= quota:
            owner, sums, tally, cut, share = after, then, seen, crossed, max(2, share // 2)
        else:
            aside += new
            share *= 2
        drop_tables(spark, aside)
    return owner
