"""Splits, edge samples, neighbour samples, k-hop queries, blocks, batches and negatives."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hetgraph.functions.hashing import draw_positions, hash52, uniform
from hetgraph.operators.ids import number_copies, with_row_index, with_running_total
from hetgraph.operators.structure import Adjacency, build_adjacency, slot_of, span_of
from hetgraph.runtime import materialize


# --- splits and samples -------------------------------------------------------------------


def split_masks(nodes: DataFrame, train: float = 0.8, val: float = 0.1, seed: int = 42) -> DataFrame:
    """Add ``train_mask``, ``val_mask`` and ``test_mask``; exactly one of them is true."""
    r = uniform(seed, F.col("node_type"), F.col("node_id"))
    drawn = nodes.withColumn("__r", r)
    c = F.col("__r")
    return drawn.select(
        *nodes.columns,
        (c < train).alias("train_mask"),
        ((c >= train) & (c < train + val)).alias("val_mask"),
        (c >= train + val).alias("test_mask"),
    )


def sample_edges(edges: DataFrame, ratio: float = 0.1, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """Bernoulli sample in which every edge is drawn on its own.

    With ``key``, columns that identify an edge, this is a plain filter. Without one, equal
    edges are numbered first, which costs a shuffle.
    """
    if key is None:
        columns = edges.columns
        numbered = number_copies(edges, columns)
        key = [*columns, "copy"]
    else:
        numbered = edges
    return numbered.where(uniform(seed, *[F.col(k) for k in key]) < ratio).select(*edges.columns)


# --- neighbours ---------------------------------------------------------------------------


def draw_links(frontier: DataFrame, adjacency: Adjacency, fanout: int | None, seed: int, salt: Sequence[str]) -> DataFrame:
    """For each frontier row and edge type, up to ``fanout`` links without replacement; all for ``None``.

    ``frontier`` has ``node_type, node_id`` and the columns in ``salt``, which enter the draw.
    A row is first expanded to its few drawn positions and then fetches exactly those links,
    so a super node in the frontier never meets its full neighbour list.
    """
    near = {"near_type": "node_type", "near": "node_id"}
    keys, stored = ["node_type", "node_id"], adjacency.span_rows is not None
    links, heads = adjacency.links.withColumnsRenamed(near), adjacency.heads
    if fanout is None and not stored:
        # Everything is wanted: meet the links by node, no positions are listed.
        return frontier.join(links.drop("pos"), keys).select(*frontier.columns, "rel", "far_type", "far")
    asked = frontier
    if stored:
        # The condition holds for every row; it tells the planner that the frontier is worth pruning by.
        asked = frontier.withColumn("slot", slot_of(*keys, adjacency.slots)).where("slot >= 0")
        keys = ["slot", *keys]
    met = asked.join(heads.withColumnsRenamed(near), keys)
    if fanout is None:
        first, last = (span_of(p, adjacency.span_rows) for p in (F.col("start"), F.col("start") + F.col("degree") - 1))
        spans = met.select(*frontier.columns, "rel", "far_type", F.explode(F.sequence(first, last)).alias("span"))
        # Written, so that the planner knows how little there is to prune by.
        spans = materialize(spans, "spans")
        whole = ["span", "node_type", "node_id", "rel", "far_type"]
        return spans.where("span >= 0").join(links.drop("pos"), whole).select(*frontier.columns, "rel", "far_type", "far")
    positions = draw_positions(
        F.col("degree"),
        fanout,
        seed,
        *[F.col(c) for c in salt],
        F.col("node_type"),
        F.col("node_id"),
        F.col("rel"),
        F.col("far_type"),
    )
    wanted = met.withColumn("__at", F.explode(positions)).select(
        *frontier.columns, (F.col("start") + F.col("__at")).alias("pos")
    )
    place = ["pos"]
    if stored:
        wanted = materialize(wanted.withColumn("span", span_of("pos", adjacency.span_rows)), "wanted").where("span >= 0")
        place = ["span", "pos"]
    links = links.select(*place, "rel", "far_type", "far")
    return wanted.join(links, place).drop(*place)


def _adjacency_of(edges: DataFrame | Adjacency, frontier: DataFrame, fanout: int | None, direction: str) -> Adjacency:
    """The links of the frontier's nodes: laid out now, from those edges alone, unless they are laid out already."""
    if isinstance(edges, Adjacency):
        return edges
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    nodes = frontier.select(F.col("node_type").alias(f"{near}_type"), F.col("node_id").alias(near)).distinct()
    mine = edges.join(nodes, [f"{near}_type", near], "left_semi")
    if fanout is not None:
        return build_adjacency(mine, direction)
    names = {f"{near}_type": "near_type", f"{far}_type": "far_type", near: "near", far: "far"}
    return Adjacency(mine.withColumnsRenamed(names).withColumn("pos", F.lit(0)), mine)


def _widely(edges: DataFrame, frontier: DataFrame, direction: str) -> bool:
    """Whether the frontier holds at least half of the nodes that have links, by sketches of both."""
    near = "src" if direction == "out" else "dst"
    ends = edges.agg(F.approx_count_distinct(F.xxhash64(f"{near}_type", near))).first()[0]
    return 2 * frontier.select("node_type", "node_id").agg(F.approx_count_distinct(F.xxhash64("node_type", "node_id"))).first()[0] >= ends


def fanout_sample(edges: DataFrame, k: int, seed: int = 42, direction: str = "out") -> DataFrame:
    """For every node and edge type at most ``k`` of its links; all of them if there are no more."""
    adjacency = build_adjacency(edges, direction)
    frontier = adjacency.heads.select(F.col("near_type").alias("node_type"), F.col("near").alias("node_id")).distinct()
    drawn = draw_links(frontier, adjacency, k, seed, [])
    return _oriented(drawn, direction)


def _oriented(drawn: DataFrame, direction: str) -> DataFrame:
    near, far = ("src", "dst") if direction == "out" else ("dst", "src")
    kept = [c for c in drawn.columns if c not in ("node_type", "node_id", "rel", "far_type", "far")]
    return drawn.select(
        *kept,
        F.col("node_type" if near == "src" else "far_type").alias("src_type"),
        "rel",
        F.col("far_type" if near == "src" else "node_type").alias("dst_type"),
        F.col("node_id" if near == "src" else "far").alias("src"),
        F.col("far" if near == "src" else "node_id").alias("dst"),
    )


def khop_edges(
    seeds: DataFrame,
    edges: DataFrame | Adjacency,
    num_hops: int = 2,
    max_neighbors: Sequence[int] | None = (15, 10),
    seed: int = 42,
    direction: str = "out",
) -> DataFrame:
    """Sampled neighbourhood of every seed: ``seed_type, seed_id, hop, src_type, rel, dst_type, src, dst``.

    Hop ``h`` keeps at most ``max_neighbors[h]`` links per node and edge type (the last value
    serves further hops, ``None`` keeps all). The next frontier is a set, but nodes met on an
    earlier hop are expanded again with a fresh draw.
    """
    frontier = seeds.select("seed_type", "seed_id").distinct().select(
        "seed_type", "seed_id", F.col("seed_type").alias("node_type"), F.col("seed_id").alias("node_id")
    )
    hops = []
    for hop in range(num_hops):
        fanout = None if max_neighbors is None else max_neighbors[min(hop, len(max_neighbors) - 1)]
        adjacency = _adjacency_of(edges, frontier, fanout, direction)
        drawn = draw_links(
            frontier.withColumn("hop", F.lit(hop)), adjacency, fanout, seed, ["seed_type", "seed_id", "hop"]
        )
        if hop + 1 < num_hops:
            drawn = materialize(drawn, f"hop{hop}")
            frontier = drawn.select(
                "seed_type", "seed_id", F.col("far_type").alias("node_type"), F.col("far").alias("node_id")
            ).distinct()
        hops.append(_oriented(drawn, direction))
    return reduce(DataFrame.unionByName, hops)


def khop_counts(
    seeds: DataFrame, edges: DataFrame, num_hops: int = 2, direction: str = "out", listed: int = 65_536
) -> DataFrame:
    """Links and different far ends of whole neighbourhoods: ``seed_type, seed_id, hop, rel, num_edges, num_nodes``.

    What ``khop_edges`` without a fan-out gives, counted, but the links of the last hop, of which there are a node's degree
    times the seeds that reach it, are not laid out as rows: their number is a sum of degrees, and a seed gets the
    neighbour lists of its nodes to count the different ends in. Seeds with more than ``listed`` links of a relation there, and so
    nodes with that many, are counted by row, so no list is longer.
    """
    seed, far = ["seed_type", "seed_id"], "dst" if direction == "out" else "src"
    before = khop_edges(seeds, edges, num_hops - 1, None, direction=direction) if num_hops > 1 else None
    if before is None:
        frontier = seeds.select(*seed, F.col("seed_type").alias("node_type"), F.col("seed_id").alias("node_id"))
    else:
        before = materialize(before, "hops")
        last = before.where(F.col("hop") == num_hops - 2)
        frontier = last.select(*seed, F.col(f"{far}_type").alias("node_type"), F.col(far).alias("node_id"))
    frontier = materialize(frontier.distinct(), "frontier")

    names = {"near_type": "node_type", "near": "node_id"}
    links = _adjacency_of(edges, frontier, None, direction).links.withColumnsRenamed(names)
    node = ["node_type", "node_id"]
    heads = links.groupBy(*node, "rel").agg(F.count(F.lit(1)).alias("degree"))
    totals = materialize(
        frontier.join(heads, node).groupBy(*seed, "rel").agg(F.sum("degree").alias("num_edges")), "totals"
    )
    large = totals.where(F.col("num_edges") > listed).select(*seed, "rel")
    some = not large.isEmpty()

    if some:
        links = links.join(heads.where(F.col("degree") <= listed).drop("degree"), [*node, "rel"], "left_semi")
    lists = links.groupBy(*node, "rel").agg(F.collect_list("far").alias("fars"))
    met = frontier.join(lists, node).select(*seed, "rel", "fars")
    if some:
        met = met.join(large, [*seed, "rel"], "left_anti")
    # At most ``listed`` numbers in one group.
    ends = met.groupBy(*seed, "rel").agg(F.size(F.array_distinct(F.flatten(F.collect_list("fars")))).cast("long").alias("num_nodes"))
    if some:
        by_row = frontier.join(large.select(*seed).distinct(), seed, "left_semi").join(
            _adjacency_of(edges, frontier, None, direction).links.withColumnsRenamed(names), node
        )
        by_row = by_row.join(large, [*seed, "rel"], "left_semi")
        ends = ends.unionByName(by_row.groupBy(*seed, "rel").agg(F.count_distinct("far").alias("num_nodes")))
    counted = totals.join(ends, [*seed, "rel"]).select(
        *seed, F.lit(num_hops - 1).alias("hop"), "rel", "num_edges", "num_nodes"
    )
    if before is None:
        return counted
    earlier = before.groupBy(*seed, "hop", "rel").agg(
        F.count(F.lit(1)).alias("num_edges"), F.count_distinct(far).alias("num_nodes")
    )
    return earlier.unionByName(counted)


def khop_nodes(seeds: DataFrame, sampled: DataFrame, direction: str = "out") -> DataFrame:
    """Nodes of each sampled neighbourhood as a set; a seed without edges keeps itself."""
    far = "dst" if direction == "out" else "src"
    own = seeds.select("seed_type", "seed_id", F.col("seed_type").alias("node_type"), F.col("seed_id").alias("node_id"))
    met = sampled.select("seed_type", "seed_id", F.col(f"{far}_type").alias("node_type"), F.col(far).alias("node_id"))
    return own.unionByName(met).distinct()


def khop_shared(
    seeds: DataFrame,
    edges: DataFrame | Adjacency,
    num_hops: int = 2,
    max_neighbors: Sequence[int] | None = (15, 10),
    seed: int = 42,
    direction: str = "out",
) -> tuple[DataFrame, DataFrame]:
    """Neighbourhoods of many seeds that share their draws: ``(links, reached)``.

    ``links`` (``hop, src_type, rel, dst_type, src, dst``) holds what was drawn at each node of each hop, once however many
    seeds meet there: a draw depends on node and hop, not on the seed. ``reached`` (``seed_type, seed_id, hop, node_type,
    node_id``) says which seeds meet at which node. ``links_of_seeds`` gives each seed its own links.
    """
    reached = seeds.select("seed_type", "seed_id").distinct().select(
        "seed_type", "seed_id", F.col("seed_type").alias("node_type"), F.col("seed_id").alias("node_id")
    )
    hops, sets = [], []
    for hop in range(num_hops):
        fanout = None if max_neighbors is None else max_neighbors[min(hop, len(max_neighbors) - 1)]
        frontier = reached.select(F.lit(hop).alias("hop"), "node_type", "node_id").distinct()
        drawn = draw_links(frontier, _adjacency_of(edges, frontier, fanout, direction), fanout, seed, ["hop"])
        drawn = materialize(drawn, f"shared{hop}")
        hops.append(_oriented(drawn, direction))
        sets.append(reached.withColumn("hop", F.lit(hop)))
        if hop + 1 < num_hops:
            steps = drawn.select("node_type", "node_id", "far_type", "far").distinct()
            met = reached.join(steps, ["node_type", "node_id"]).select(
                "seed_type", "seed_id", F.col("far_type").alias("node_type"), F.col("far").alias("node_id")
            )
            reached = materialize(met.distinct(), f"reached{hop + 1}")
    reached = reduce(DataFrame.unionByName, sets).select("seed_type", "seed_id", "hop", "node_type", "node_id")
    return reduce(DataFrame.unionByName, hops), reached


def links_of_seeds(links: DataFrame, reached: DataFrame, direction: str = "out") -> DataFrame:
    """The links of ``khop_shared`` for each seed, in the columns of ``khop_edges``."""
    near = "src" if direction == "out" else "dst"
    here = reached.withColumnsRenamed({"node_type": f"{near}_type", "node_id": near})
    return here.join(links, ["hop", f"{near}_type", near]).select(
        "seed_type", "seed_id", "hop", "src_type", "rel", "dst_type", "src", "dst"
    )


def neighbor_blocks(
    targets: DataFrame,
    edges: DataFrame | Adjacency,
    fanouts: Sequence[int | None] = (15, 10, 5),
    seed: int = 42,
    direction: str = "in",
) -> DataFrame:
    """Layered sample for one batch of target nodes, from the output layer inwards.

    ``fanouts`` are given from the input layer to the output layer, so the last one is used
    first. A node is sampled once per layer however many targets reach it. The nodes of a
    layer are those of the layer above it and the far ends drawn there. Links are laid out for the nodes of a layer; once a
    layer, whose nodes belong to all later ones, has half of the nodes, all links are laid out for the rest of the layers.
    """
    frontier = targets.select("node_type", "node_id").distinct()
    layers = []
    for layer in range(len(fanouts) - 1, -1, -1):
        again = layer > 0 and all(f is not None for f in fanouts[: layer + 1])
        if again and not isinstance(edges, Adjacency) and _widely(edges, frontier, direction):
            edges = build_adjacency(edges, direction)
        adjacency = _adjacency_of(edges, frontier, fanouts[layer], direction)
        drawn = draw_links(frontier.withColumn("layer", F.lit(layer)), adjacency, fanouts[layer], seed, ["layer"])
        if layer:
            drawn = materialize(drawn, f"layer{layer}")
            far = drawn.select(F.col("far_type").alias("node_type"), F.col("far").alias("node_id"))
            frontier = frontier.unionByName(far).distinct()
        layers.append(_oriented(drawn, direction))
    return reduce(DataFrame.unionByName, layers)


def full_neighbors(targets: DataFrame, edges: DataFrame) -> DataFrame:
    """All in-edges of the target nodes, one layer."""
    wanted = targets.select(F.col("node_type").alias("dst_type"), F.col("node_id").alias("dst")).distinct()
    return edges.join(wanted, ["dst_type", "dst"], "left_semi")


def block_inputs(blocks: DataFrame, targets: DataFrame, features: DataFrame) -> DataFrame:
    """Features of every node that the sampled layers read; nodes without features are left out."""
    ends = blocks.select(
        F.inline(
            F.array(
                F.struct(F.col("src_type").alias("node_type"), F.col("src").alias("node_id")),
                F.struct(F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id")),
            )
        )
    )
    needed = ends.unionByName(targets.select("node_type", "node_id")).distinct()
    return features.where("feature_vec IS NOT NULL").join(needed, ["node_type", "node_id"], "left_semi")


# --- training ids -------------------------------------------------------------------------


def even_split(ids: DataFrame, workers: int) -> DataFrame:
    """Give each worker a run of ids; run lengths differ by at most one."""
    ranked = with_row_index(ids.select("node_type", "node_id"), ["node_type", "node_id"], "__rank")
    total = ranked.select(F.max("__rank") + 1).scalar()
    return ranked.select(
        "node_type", "node_id", F.floor(F.col("__rank") * workers / total).cast("long").alias("worker")
    )


def owner_split(ids: DataFrame, partition: Column, workers: int) -> DataFrame:
    """Give each id to the worker that owns its partition; sizes follow the partitions."""
    return ids.select("node_type", "node_id", F.pmod(partition, F.lit(workers)).cast("long").alias("worker"))


def mini_batches(ids: DataFrame, batch_size: int = 1024, epochs: int = 1, seed: int | None = 42) -> DataFrame:
    """``epoch, batch_id, slot, node_type, node_id``; the last short batch stays.

    With a seed each epoch has its own random order, without one the order is that of the ids.
    """
    repeated = ids.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))).alias("epoch"),
        "node_type",
        "node_id",
    )
    order = ["node_type", "node_id"]
    if seed is not None:
        repeated = repeated.withColumn(
            "__key", hash52(seed, F.col("epoch"), F.col("node_type"), F.col("node_id"))
        )
        order = ["__key", *order]
    ranked = with_row_index(repeated, order, "__rank", group_by=["epoch"])
    return ranked.select(
        "epoch",
        F.floor(F.col("__rank") / batch_size).cast("long").alias("batch_id"),
        F.pmod(F.col("__rank"), F.lit(batch_size)).cast("long").alias("slot"),
        "node_type",
        "node_id",
    )


def negative_edges(edges: DataFrame, ranges: DataFrame, k: int = 1, seed: int = 42) -> DataFrame:
    """For every distinct edge up to ``k`` edges that are not in the graph.

    ``edges`` are in global ids and ``ranges`` is ``id_ranges`` of the map. Targets are drawn
    evenly from the id range of the target type; those that hit a true edge are removed.
    """
    known = edges.select("src_type", "rel", "dst_type", "src", "dst").distinct()
    # One row per node type.
    spans = ranges.select(F.col("node_type").alias("dst_type"), "start_id", "num_ids")
    draws = (
        known.join(F.broadcast(spans), "dst_type")
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .select(
            "src_type",
            "rel",
            "dst_type",
            "src",
            (
                F.col("start_id")
                + F.pmod(
                    hash52(seed, F.col("rel"), F.col("src"), F.col("dst"), F.col("draw")), F.col("num_ids")
                )
            ).alias("dst"),
        )
    )
    return draws.join(known, ["src_type", "rel", "dst_type", "src", "dst"], "left_anti")


def exact_negatives(edges: DataFrame, ranges: DataFrame, k: int = 1, seed: int = 42, listed: int = 1024) -> DataFrame:
    """For every distinct edge ``min(k, candidates)`` different edges that are not in the graph.

    ``edges`` and ``ranges`` as for ``negative_edges``. Candidates of an edge are the ids of the target type that its
    source has no link to under its relation. Nothing is drawn and thrown away, and no candidates are listed: of the
    ``c`` candidates of a source, ``k`` ranks out of ``0 .. c-1`` are drawn (Floyd's method), and the one of rank r is
    r plus the number of neighbours up to it. With the neighbours numbered ``d_0 < d_1 < ...`` from the start of the range
    these are the ones with ``d_j - j <= r``. A source of at most ``listed`` links holds its gaps ``d_j - j`` as a list, and its
    edges count in it. For others gaps and ranks are put into one order by source, and the count
    is a running total, so a source that has links to a third of all ids is spread over the sort's partitions like
    any other. Ends outside the range of their type are no neighbours. Edges of a type without a range have no candidates.
    """
    source = ["src_type", "rel", "dst_type", "src"]
    known = materialize(edges.select(*source, "dst").where("src IS NOT NULL").distinct(), "known")
    # One row per node type.
    spans = F.broadcast(ranges.select(F.col("node_type").alias("dst_type"), "start_id", "num_ids"))
    large = known.groupBy(*source).agg(F.count(F.lit(1)).alias("links")).where(F.col("links") > listed)
    large = materialize(large.select(*source), "large")
    if large.isEmpty():
        return _negatives_by_list(known, spans, k, seed, listed)
    by_row = _negatives_by_row(materialize(known.join(large, source, "left_semi"), "known"), spans, k, seed)
    return _negatives_by_list(known.join(large, source, "left_anti"), spans, k, seed, max(listed, 1)).unionByName(by_row)


def _negatives_by_list(known: DataFrame, spans: DataFrame, k: int, seed: int, listed: int) -> DataFrame:
    """``exact_negatives`` of sources with few links: one exchange by source."""
    source = ["src_type", "rel", "dst_type", "src"]
    # In structs, since a list leaves out nulls.
    lists = known.join(spans, "dst_type").groupBy(*source, "start_id", "num_ids").agg(F.collect_list(F.struct("dst")).alias("ends"))
    places = F.transform("ends", lambda e: e["dst"] - F.col("start_id"))
    inside = F.sort_array(F.filter(places, lambda d: (d >= 0) & (d < F.col("num_ids"))))
    gaps = lists.select(*source, "start_id", "num_ids", "ends", F.transform(inside, lambda d, i: d - i).alias("gaps"))
    each = gaps.select(*source, "start_id", "num_ids", "gaps", F.explode("ends.dst").alias("dst"))
    ranks = draw_positions(F.col("num_ids") - F.size("gaps"), k, seed, *[F.col(c) for c in source], F.col("dst"))
    drawn = each.select(*source, "dst", "start_id", "gaps", F.explode(ranks).alias("at"))
    # Gaps do not fall: how many are at most a rank is found by halving.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(listed.bit_length()))])
    below = F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(F.get("gaps", n + step - 1) <= F.col("at"), n + step).otherwise(n)
    )
    return drawn.select(*source, "dst", (F.col("start_id") + F.col("at") + below).alias("negative"))


def _negatives_by_row(known: DataFrame, spans: DataFrame, k: int, seed: int) -> DataFrame:
    """``exact_negatives`` of sources with any number of links: two range sorts."""
    triple = ["src_type", "rel", "dst_type"]
    inside = known.join(spans, "dst_type").where("dst >= start_id AND dst < start_id + num_ids")
    links = with_row_index(inside.select(*triple, "src", "dst", "start_id"), ["src", *triple, "dst"], "pos")
    links = materialize(links, "neighbours")
    heads = links.groupBy(*triple, "src").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("degree"))
    heads = materialize(heads, "sources")

    none = F.lit(0).cast("long")
    met = known.join(spans, "dst_type").join(heads, [*triple, "src"], "left")
    candidates = F.col("num_ids") - F.coalesce("degree", none)
    ranks = draw_positions(candidates, k, seed, *[F.col(c) for c in triple], F.col("src"), F.col("dst"))
    drawn = met.select(
        *triple, "src", F.col("dst").alias("of"), "start_id", "first", F.explode(ranks).alias("at"), F.lit(1).alias("kind")
    )
    gaps = links.join(heads, [*triple, "src"]).select(
        *triple,
        "src",
        F.col("dst").alias("of"),
        "start_id",
        "first",
        (F.col("dst") - F.col("start_id") - (F.col("pos") - F.col("first"))).alias("at"),
        F.lit(0).alias("kind"),
    )
    both = gaps.unionByName(drawn).withColumn("__gap", (F.col("kind") == 0).cast("long"))
    # Equal gaps, as a run of neighbours has them, and equal ranks are told apart by the end of their edge.
    counted, _ = with_running_total(both, ["src", *triple, "at", "kind", "of"], "__gap", "__before")
    return counted.where("kind = 1").select(
        *triple,
        "src",
        F.col("of").alias("dst"),
        (F.col("start_id") + F.col("at") + F.coalesce(F.col("__before") - F.col("first"), none)).alias("negative"),
    )
