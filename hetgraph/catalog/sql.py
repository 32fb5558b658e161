"""Named SQL fragments from which the check queries are put together (DuckDB dialect)."""

from __future__ import annotations

SNAP = "'2024-01-01'"


def h52(*parts) -> str:
    """The md5 draw of hetgraph.functions.hashing as SQL."""
    return f"(('0x' || substr(md5(concat_ws(':', {', '.join(str(p) for p in parts)})), 1, 13))::BIGINT)"


def uni(*parts) -> str:
    return f"({h52(*parts)} / 4503599627370496.0)"


def r4(x: str) -> str:
    return f"CASE WHEN abs({x}) < 0.00005 THEN 0.0 ELSE round({x}, 4) END"


def wmat(row: str, col: str, slot: str = "0") -> str:
    return f"(sin(7.0 * ({row}) + 13.0 * ({col}) + 3.0 * ({slot})) / 8)"


def wbias(row: str, slot: str = "0") -> str:
    return f"(sin(5.0 * ({row}) + 3.0 * ({slot})) / 8)"


def draw(deg: str, k: int, *key) -> str:
    """Floyd's subset draw as a list of positions."""
    return f"""CASE WHEN {deg} <= {k} THEN range(0, {deg}) ELSE list_reduce(
      list_prepend([]::BIGINT[], list_transform(range({deg} - {k}, {deg}), lambda j: [j, {h52(*key, 'j')} % (j + 1)])),
      lambda acc, x: list_append(acc, CASE WHEN list_contains(acc, x[2]) THEN x[1] ELSE x[2] END)) END"""


# name -> (needs, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "nodes_user": (
        (),
        f"""SELECT c.c_custkey AS node_id, e.embedding AS feature_vec, e.label AS label, {SNAP} AS dt
        FROM customer c JOIN embeddings e ON e.vec_id = c.c_custkey % (SELECT count(*) FROM embeddings)""",
    ),
    "nodes_item": (
        (),
        f"""SELECT p.p_partkey AS node_id, e.embedding AS feature_vec, e.label AS label, {SNAP} AS dt
        FROM part p JOIN embeddings e ON e.vec_id = (p.p_partkey * 7 + 3) % (SELECT count(*) FROM embeddings)""",
    ),
    "nodes": (
        ("nodes_user", "nodes_item"),
        """SELECT 'user' AS node_type, node_id, feature_vec, label FROM nodes_user
        UNION ALL SELECT 'item', node_id, feature_vec, label FROM nodes_item""",
    ),
    "edges_purchase": (
        (),
        """SELECT o.o_custkey AS src, l.l_partkey AS dst, CAST(l.l_quantity AS FLOAT) AS edge_weight
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    ),
    "edges_click": (
        (),
        """SELECT user_id AS src, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS dst,
        CAST(value AS FLOAT) AS edge_weight FROM events WHERE event_type = 'click'""",
    ),
    "edges_similar": (
        (),
        """SELECT l_partkey AS src, (l_partkey + l_suppkey) % (SELECT count(*) FROM part) AS dst,
        CAST(l_discount AS FLOAT) AS edge_weight FROM lineitem""",
    ),
    "edges": (
        ("edges_purchase", "edges_click", "edges_similar"),
        """SELECT 'user' AS src_type, 'click' AS rel, 'item' AS dst_type, src, dst, edge_weight FROM edges_click
        UNION ALL SELECT 'user', 'purchase', 'item', src, dst, edge_weight FROM edges_purchase
        UNION ALL SELECT 'item', 'similar', 'item', src, dst, edge_weight FROM edges_similar""",
    ),
    "gid": (
        ("nodes",),
        """SELECT node_type, node_id,
        row_number() OVER (ORDER BY CASE node_type WHEN 'user' THEN 0 ELSE 1 END, node_id) - 1 AS global_id
        FROM (SELECT DISTINCT node_type, node_id FROM nodes)""",
    ),
    "gedges": (
        ("edges", "gid"),
        """SELECT e.src_type, e.rel, e.dst_type, s.global_id AS src, d.global_id AS dst, e.edge_weight
        FROM edges e JOIN gid s ON s.node_type = e.src_type AND s.node_id = e.src
        JOIN gid d ON d.node_type = e.dst_type AND d.node_id = e.dst""",
    ),
    "masks": (
        ("nodes",),
        f"""SELECT node_type, node_id, label, r < 0.8 AS train_mask, r >= 0.8 AND r < 0.8 + 0.1 AS val_mask,
        r >= 0.8 + 0.1 AS test_mask FROM (SELECT *, {uni(42, 'node_type', 'node_id')} AS r FROM nodes)""",
    ),
    "links_out": (
        ("edges",),
        """SELECT src_type AS near_type, rel, dst_type AS far_type, src AS near, dst AS far,
        row_number() OVER (PARTITION BY src_type, rel, dst_type, src ORDER BY dst) - 1 AS at_pos FROM edges""",
    ),
    "links_in": (
        ("edges",),
        """SELECT dst_type AS near_type, rel, src_type AS far_type, dst AS near, src AS far,
        row_number() OVER (PARTITION BY src_type, rel, dst_type, dst ORDER BY src) - 1 AS at_pos FROM edges""",
    ),
    "heads_out": (
        ("links_out",),
        "SELECT near_type, rel, far_type, near, count(*) AS degree FROM links_out GROUP BY ALL",
    ),
    "heads_in": (
        ("links_in",),
        "SELECT near_type, rel, far_type, near, count(*) AS degree FROM links_in GROUP BY ALL",
    ),
    # Hidden states: features through a closed-form 64 -> 8 projection, one row per entry.
    "x": (
        ("nodes",),
        """SELECT node_type, node_id, unnest(range(64)) AS j, unnest(feature_vec)::DOUBLE AS v FROM nodes""",
    ),
    "h": (
        ("x",),
        f"""SELECT node_type, node_id, o, sum(v * {wmat('o', 'j', "CASE node_type WHEN 'user' THEN 1 ELSE 2 END")})
        + {wbias('o', "CASE node_type WHEN 'user' THEN 1 ELSE 2 END")} AS v
        FROM x, range(8) t(o) GROUP BY node_type, node_id, o""",
    ),
    # Edge types numbered as the model numbers them.
    "et": (
        (),
        """SELECT * FROM (VALUES ('user', 'click', 'item', 3), ('user', 'purchase', 'item', 4),
        ('item', 'similar', 'item', 5)) t(src_type, rel, dst_type, slot)""",
    ),
    "requests": (
        (),
        """SELECT event_id, CASE WHEN event_type = 'view' THEN 'item' ELSE 'user' END AS node_type,
        CASE WHEN event_type = 'view' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 30
        ELSE user_id END AS node_id FROM events""",
    ),
    "runs": (
        (),
        """SELECT l_suppkey AS run_id, epoch, (sum(l_discount::DECIMAL(18, 4))::DOUBLE / count(*)::DOUBLE) AS score
        FROM (SELECT *, (year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS epoch FROM lineitem)
        GROUP BY l_suppkey, epoch""",
    ),
}


def oracle(needs: list[str] | tuple[str, ...], body: str, recursive: bool = False) -> str:
    """``body`` behind the fragments it needs."""
    ordered: list[str] = []

    def visit(name):
        for n in CTES[name][0]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    parts = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered]
    if not parts:
        return body
    sep = ", " if body.lstrip().startswith("+") else " "
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(parts) + sep + body.lstrip().removeprefix("+")
