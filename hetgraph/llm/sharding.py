"""Shards of even size that keep linked documents together, by balanced label propagation.

Documents of one group are linked with each other (here: equal texts). A group of more than a sixteenth of a
shard is placed first, largest first: it fills as many whole shards as it can, and the rest of it goes where it
fits most closely. The other documents start in hashed shards, in proportion to what is free. In each round every
linked one wants to go to the shard in which most of its neighbours are, ties and crowded shards
decided by hash; as many go as can without a shard growing beyond its quota, drawn by hash (Ugander and
Backstrom, 2013). What leaves a shard in the same round is room. A last pass evens out what the draws
left: documents without links move first, those of placed groups last.

Links are never expanded into pairs: a group's neighbours are counts per shard. What comes to the
driver is one number per shard or pair of shards, and the sizes of the groups placed first, about
sixteen per shard at most.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import utf8
from hetgraph.operators.ids import with_row_index
from hetgraph.runtime import materialize

SHARDS, ROUNDS = 24, 6
#: Groups of more than this part of a shard are placed before the rounds.
LARGE = 16
#: Weight of the draw against the share of its wishes that a shard could grant in the last round.
LUCK = 0.3


def _flows(room: list[int], wish: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """Share of the wishes from a shard to another that may be granted.

    Documents move along closed chains of shards, or along chains that end in a shard with room; the
    shard that such a chain starts from has more room then.
    """
    left, room, ahead = dict(wish), list(room), defaultdict(set)
    for s, t in wish:
        ahead[s].add(t)

    def chain(s: int, t: int) -> list[int]:
        """The shortest from ``s`` by way of ``t``."""
        came, line = {t: s}, [t]
        for u in line:
            if u == s or room[u] > 0:
                found = [u]
                while found[-1] != t:
                    found.append(came[found[-1]])
                return [s, *reversed(found)]
            for v in sorted(ahead[u]):
                if v not in came:
                    came[v] = u
                    line.append(v)
        return []

    moved = True
    while moved:
        moved = False
        # Crowded shards first.
        for s, t in sorted(wish, key=lambda p: (room[p[0]], p)):
            while left[s, t] and (found := chain(s, t)):
                steps, last = list(zip(found, found[1:])), found[-1]
                n = min([left[x] for x in steps] + ([room[last]] if last != s else []))
                for x in steps:
                    left[x] -= n
                    if not left[x]:
                        ahead[x[0]].discard(x[1])
                if last != s:
                    room[last] -= n
                    room[s] += n
                moved = True
    return {x: 1 - left[x] / n for x, n in wish.items()}


def _table(spark, rows: dict[tuple[int, int], float]) -> DataFrame:
    return spark.createDataFrame([(s, t, x) for (s, t), x in rows.items()], "shard int, to int, share double")


def _pick(xs: list, kind: str, i):
    """The entry of a short list that ``i`` names."""
    return F.get(F.array(*(F.lit(x).cast(kind) for x in xs)), i)


def _draw(*keys):
    """An even number from 0 to 1 for the keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(linked: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``linked (rid, grp, shard)`` after the rounds, no more than its quota in a shard but for the luck of draws.

    Documents without links do not count: they fill the gaps afterwards.
    """
    spark, load, ease = linked.sparkSession, [0] * len(quota), [1.0] * len(quota)
    for r in linked.groupBy("shard").count().collect():
        load[r["shard"]] = r["count"]
    for turn in range(rounds):
        counts = linked.groupBy("grp", "shard").agg(F.count("*").alias("m"))
        pull = F.col("m") * (_pick(ease, "double", F.col("shard")) + LUCK * _draw("grp", "shard", F.lit(turn)))
        best = counts.groupBy("grp").agg(F.max_by("shard", F.struct(pull.alias("pull"), "shard")).alias("to"))
        wants = materialize(linked.join(best, "grp"), "wants")
        moving = wants.where("shard <> to").groupBy("shard", "to").agg(F.count("*").alias("n")).collect()
        if not moving:
            break
        wish = {(r["shard"], r["to"]): r["n"] for r in moving}
        granted = _flows([q - x for q, x in zip(quota, load)], wish)
        asked, got = [0] * len(quota), [0.0] * len(quota)
        for (s, t), n in wish.items():
            asked[t] += n
            got[t] += n * granted[s, t]
        ease = [(g / a) ** 0.5 if a else 1.0 for g, a in zip(got, asked)]
        if not any(granted.values()):
            continue
        share = F.broadcast(_table(spark, granted))  # one row per pair of shards
        linked = materialize(
            wants.join(share, ["shard", "to"], "left").select(
                "rid", "grp", F.when(_draw("rid", F.lit(turn)) < F.coalesce("share", F.lit(0.0)), F.col("to")).otherwise(F.col("shard")).alias("shard"),
                F.col("shard").alias("was"),
            ),
            "moved",
        )
        for r in linked.where("shard <> was").groupBy("shard", "was").count().collect():
            load[r["shard"]] += r["count"]
            load[r["was"]] -= r["count"]
        linked = linked.drop("was")
    return linked


def _plan(groups: list[tuple[str, int]], room: list[int]) -> dict[str, list[tuple[int, int]]]:
    """``(shard, rows)`` for each of the large groups; ``room`` becomes what they leave free."""
    plan = {}
    for grp, n in sorted(groups, key=lambda x: (-x[1], x[0])):
        plan[grp] = parts = []
        while n:
            fits = [s for s, x in enumerate(room) if x >= n]
            s = min(fits, key=lambda s: room[s]) if fits else max(range(len(room)), key=lambda s: room[s])
            # Without any room the rows left over, fewer than shards, go one by one.
            m = min(n, max(room[s], 1))
            parts.append((s, m))
            room[s] -= m
            n -= m
    return plan


def _placed_first(rows: DataFrame, plan: dict[str, list[tuple[int, int]]]) -> DataFrame:
    """``(rid, moved)`` of the rows of large groups: runs of each group in the order of the plan."""
    table, at = [], 0
    for grp in sorted(plan):
        ends = [at + x for x in accumulate(m for _, m in plan[grp])]
        table.append((grp, ends, [s for s, _ in plan[grp]]))
        at = ends[-1]
    # One row per large group.
    runs = F.broadcast(rows.sparkSession.createDataFrame(table, "grp string, ends array<long>, to array<int>"))
    ranked = with_row_index(rows.join(runs.select("grp"), "grp", "left_semi").select("grp", "rid"), ["grp", "rid"], "r")
    return ranked.join(runs, "grp").select("rid", F.expr("get(to, size(filter(ends, e -> e <= r)))").alias("moved"))


def _even(placed: DataFrame, load: list[int], order: list[str]) -> DataFrame:
    """``shard`` and ``slot`` with counts at most one apart: each shard's last rows fill the gaps."""
    n, k = sum(load), len(load)
    # The largest shards keep the extra rows.
    extra = set(sorted(range(k), key=lambda s: (-load[s], s))[: n % k])
    quota = [n // k + (s in extra) for s in range(k)]
    over = [max(0, x - q) for x, q in zip(load, quota)]
    under = [max(0, q - x) for x, q in zip(load, quota)]
    over_at, under_at = [0, *accumulate(over)], [0, *accumulate(under)]
    pick = lambda xs, i: _pick(xs, "long", i)
    ranked = with_row_index(placed, order, "r", group_by=["shard"])
    spare = F.col("r") - pick(quota, F.col("shard")) + pick(over_at, F.col("shard"))
    # The number of gap ranges that begin at or before a spare row's number names its shard.
    gap = sum(((F.col("j") >= F.lit(under_at[t + 1])).cast("int") for t in range(k)), F.lit(0))
    fills = F.col("r") >= pick(quota, F.col("shard"))
    return (
        ranked.withColumn("j", F.when(fills, spare)).withColumn("t", gap)
        .withColumn("slot", F.when(fills, F.col("j") - pick(under_at, F.col("t")) + pick(load, F.col("t"))).otherwise(F.col("r")))
        .withColumn("shard", F.when(fills, F.col("t")).otherwise(F.col("shard")))
        .drop("r", "j", "t")
    )


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs (doc_id, text, ...)``.

    The law is ``rows``: counts are at most one apart and slots have no gaps. Groups are equal texts; a
    null text is an empty one. Null ids and repeated rows are rows like all others; other columns are
    ignored; an empty table gives no rows. A group that is larger than a shard fills whole shards, and the rest of
    it goes to one more.
    """
    base = docs.select(
        "doc_id", (F.length(utf8()) + 8).cast("long").alias("size"), F.crc32(utf8()).alias("text_crc32"), F.md5(utf8()).alias("grp")
    )
    rows = materialize(base.withColumn("rid", F.monotonically_increasing_id()), "rows")
    quota = [rows.count() // shards] * shards
    several = materialize(rows.groupBy("grp").agg(F.count("*").alias("m")).where("m > 1"), "groups")
    large = several.where(F.col("m") * LARGE > quota[0]) if quota[0] else several.limit(0)
    plan = _plan([(r["grp"], r["m"]) for r in large.collect()], quota)
    free = [max(0, x) for x in quota] if any(x > 0 for x in quota) else [1] * shards
    at = F.pmod(F.xxhash64("doc_id", "grp", "rid"), F.lit(sum(free)))
    start = sum(((at >= F.lit(x)).cast("int") for x in accumulate(free[:-1])), F.lit(0))
    small = several.join(large.select("grp"), "grp", "left_anti").select("grp")
    linked = materialize(rows.join(small, "grp", "left_semi").select("rid", "grp", start.alias("shard")), "linked")
    moved = propagate(linked, free, rounds).select("rid", F.col("shard").alias("moved"), F.lit(1).alias("last"))
    if plan:
        moved = moved.unionByName(_placed_first(rows, plan).withColumn("last", F.lit(0)))
    placed = materialize(
        rows.join(moved, "rid", "left").select(
            "doc_id", "size", "text_crc32", "grp", "rid", F.coalesce("moved", start).alias("shard"), F.coalesce("last", F.lit(2)).alias("last")
        ),
        "placed",
    )
    load = [0] * shards
    for r in placed.groupBy("shard").count().collect():
        load[r["shard"]] = r["count"]
    return _even(placed, load, ["last", "grp", "rid"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
