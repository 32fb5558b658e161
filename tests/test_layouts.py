"""How often links are laid out."""

from hetgraph.operators import sampling as S
from hetgraph.operators.structure import build_adjacency
from hetgraph.runtime import recorded


def _sorted(tables):
    return sum("/sorted-" in t for t in tables)


def test_layers_of_most_nodes_share_one_layout(spark, graph):
    nodes, edges = graph
    items = nodes.where("node_type = 'item'").select("node_type", "node_id")
    whole = build_adjacency(edges, "in")
    for targets, layouts in ((items, 1), (items.where("node_id < 3"), 3)):
        with recorded() as tables:
            got = S.neighbor_blocks(targets, edges, (4, 3, 2), 42)
        assert _sorted(tables) <= layouts
        if layouts == 1:
            assert _sorted(tables) == 1
        assert sorted(got.collect()) == sorted(S.neighbor_blocks(targets, whole, (4, 3, 2), 42).collect())
