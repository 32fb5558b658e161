"""Scans, sinks, ids, structure."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.catalog.registry import entries, query, r4
from hetgraph.catalog.sql import h52, oracle, r4 as q4, uni
from hetgraph.functions.vectors import vec_sum
from hetgraph.operators import ids as I
from hetgraph.operators import partition as P
from hetgraph.operators import sampling as S
from hetgraph.operators import structure as ST
from hetgraph.operators.cut import cut_aware_map
from hetgraph.operators.features import as_key_values, decode_vector
from hetgraph.plans.jobs import export_graph, partition_graph, sync_features_to
from hetgraph.runtime import checkpoint_root, materialize
from hetgraph.schema import EdgeType, GraphConfig, etype_name, parse_etype
from hetgraph.sinks.kv_source import put_key_values, read_key_values
from hetgraph.sinks.store import GraphStore, describe_graph, feature_dims, graph_stats
from hetgraph.sources import layout, tables
from hetgraph.sources.fixtures import CONFIG, SNAPSHOT

ETYPES = list(CONFIG.edge_types)
TYPES = list(CONFIG.node_types)


def new_store(t, chunks: int = 8) -> GraphStore:
    return GraphStore(t.spark, f"{checkpoint_root(t.spark)}/hetgraph/store-{uuid.uuid4().hex}", chunks)


def vec_digest(df, *keys):
    """Vector columns as their length and sum, which every engine can compare."""
    return df.select(
        *keys, F.size("feature_vec").cast("long").alias("dims"), r4(vec_sum("feature_vec")).alias("vec_sum")
    )


DIGEST = f"len(feature_vec) AS dims, {q4('list_sum(feature_vec::DOUBLE[])')} AS vec_sum"


@query("scan_nodes", oracle(["nodes_user"], f"SELECT 'user' AS node_type, node_id, label, {DIGEST} FROM nodes_user"))
def _(t):
    return vec_digest(tables.scan_nodes(t.nodes_user(), "user", SNAPSHOT), "node_type", "node_id", "label")


@query("node_counts", oracle(["nodes"], "SELECT node_type, count(*) AS num_nodes FROM nodes GROUP BY 1"))
def _(t):
    return tables.node_counts(t.graph()[0])


@query(
    "scan_edges",
    oracle(
        ["edges"],
        "SELECT src_type, rel, dst_type, src, dst, edge_weight::DOUBLE AS edge_weight FROM edges WHERE rel = 'purchase'",
    ),
)
def _(t):
    e = tables.scan_edges(t.edges_purchase(), ETYPES[1], SNAPSHOT)
    return e.withColumn("edge_weight", F.col("edge_weight").cast("double"))


@query("edge_counts", oracle(["edges"], "SELECT src_type, rel, dst_type, count(*) AS num_edges FROM edges GROUP BY ALL"))
def _(t):
    return tables.edge_counts(t.graph()[1])


def _stored(t, with_edges=True):
    nodes, edges = t.graph()
    id_map = I.assign_global_ids(nodes, TYPES)
    store = new_store(t)
    store.write_nodes(I.attach_global_id(nodes, id_map), TYPES)
    if with_edges:
        store.write_edges(I.rewrite_edges(edges, id_map), ETYPES)
    return store


@query(
    "roundtrip_nodes",
    oracle(["gid"], f"SELECT node_type, global_id AS node_id, label, {DIGEST} FROM nodes JOIN gid USING (node_type, node_id)"),
)
def _(t):
    return vec_digest(_stored(t, False).read_nodes(), "node_type", "node_id", "label")


_GEDGES = "SELECT src_type, rel, dst_type, src, dst, edge_weight::DOUBLE AS edge_weight FROM gedges"


@query("roundtrip_edges", oracle(["gedges"], _GEDGES))
def _(t):
    e = _stored(t).read_edges()
    return e.withColumn("edge_weight", F.col("edge_weight").cast("double"))


@query(
    "metadata_edge_types",
    oracle(
        ["edges"],
        """SELECT shape, src_type, rel, dst_type FROM (SELECT DISTINCT src_type, rel, dst_type FROM edges),
        (VALUES ('object'), ('list')) s(shape)""",
    ),
)
def _(t):
    triples = t.graph()[1].select("src_type", "rel", "dst_type").distinct()

    def text(entry, shape):
        # One entry per edge type of the graph.
        listed = triples.groupBy().agg(F.collect_list(entry).alias("edge_types"))
        return layout.metadata_edge_types(listed.select(F.to_json(F.struct("edge_types")).alias("value"))).select(
            F.lit(shape).alias("shape"), "src_type", "rel", "dst_type"
        )

    named = F.struct("src_type", F.col("rel").alias("edge_name"), "dst_type")
    return text(named, "object").unionByName(text(F.array("src_type", "rel", "dst_type"), "list"))


@query(
    "adjacency",
    oracle(
        ["links_out"],
        """SELECT near_type, rel, far_type, near, (at_pos // 1024)::BIGINT AS block,
        string_agg(far::VARCHAR, ',' ORDER BY far) AS neighbors FROM links_out GROUP BY ALL""",
    ),
)
def _(t):
    lists = ST.adjacency_lists(ST.build_adjacency(t.graph()[1]), 1024)
    return lists.withColumn("neighbors", F.array_join("neighbors", ","))


@query(
    "adjacency_stored",
    oracle(
        ["links_out"],
        """SELECT near_type, rel, far_type, near, (at_pos // 1024)::BIGINT AS block,
        string_agg(far::VARCHAR, ',' ORDER BY far) AS neighbors FROM links_out GROUP BY ALL""",
    ),
)
def _(t):
    lists = ST.adjacency_lists(stored_adjacency(t), 1024)
    return lists.withColumn("neighbors", F.array_join("neighbors", ","))


def stored_adjacency(t, direction: str = "out") -> ST.Adjacency:
    store = new_store(t)
    store.write_adjacency(t.graph()[1], direction, span_rows=50_000)
    return store.read_adjacency(direction)


@query("scan_embeddings", oracle(["nodes"], f"SELECT node_type, node_id, {DIGEST} FROM nodes WHERE node_type = 'item'"))
def _(t):
    table = t.graph()[0].withColumnRenamed("feature_vec", "embedding_vec")
    return vec_digest(tables.scan_embeddings(table, "item"), "node_type", "node_id")


@query(
    "sync_parquet",
    f"""SELECT 'gnn:feat:vec:' || vec_id AS key, 86400 AS ttl, len(embedding) AS dims,
    {q4('list_sum(embedding::DOUBLE[])')} AS vec_sum FROM embeddings""",
)
def _(t):
    rows = tables.read_feature_files(t.spark, f"{t.sf_dir}/embeddings.parquet", "vec", "vec_id", "embedding")
    return vec_digest(as_key_values(rows).withColumn("feature_vec", decode_vector("value")), "key", "ttl")


def _exported(t) -> GraphStore:
    """What a reader finds of the second of two exports to one place."""
    path = f"{checkpoint_root(t.spark)}/hetgraph/export-{uuid.uuid4().hex}"
    for chunks in (4, 8):
        export_graph(t.spark, t, GraphConfig(output_path=path, num_partitions=chunks), SNAPSHOT)
    return GraphStore(t.spark, path).pinned()


@query(
    "export_nodes",
    oracle(["gid"], f"SELECT node_type, global_id, label, {DIGEST} FROM nodes JOIN gid USING (node_type, node_id)"),
)
def _(t):
    return vec_digest(_exported(t).read_nodes().withColumnRenamed("node_id", "global_id"), "node_type", "global_id", "label")


@query(
    "export_edges",
    oracle(
        ["gedges"],
        "SELECT src_type || '__' || rel || '__' || dst_type AS etype, src, dst, edge_weight::DOUBLE AS edge_weight FROM gedges",
    ),
)
def _(t):
    e = _exported(t).read_edges()
    return e.select(etype_name().alias("etype"), "src", "dst", F.col("edge_weight").cast("double").alias("edge_weight"))


@query(
    "write_nodes",
    oracle(
        ["nodes"],
        "SELECT node_type, count(*) AS num_nodes, max(len(feature_vec))::INTEGER AS feature_dim FROM nodes GROUP BY 1",
    ),
)
def _(t):
    store = new_store(t)
    renamed = t.graph()[0].withColumnsRenamed({"node_id": "nid", "feature_vec": "emb", "label": "cls"})
    store.write_nodes(renamed, TYPES, id_col="nid", feature_col="emb", label_col="cls")
    return (
        store.read_nodes()
        .groupBy("node_type")
        .agg(F.count(F.lit(1)).alias("num_nodes"), F.max(F.size("feature_vec")).alias("feature_dim"))
    )


@query(
    "write_edges",
    oracle(
        ["edges"],
        f"""SELECT src_type || '__' || rel || '__' || dst_type AS etype, count(*) AS num_edges,
        round(sum(edge_weight::DECIMAL(18, 2))::DOUBLE, 2) AS weight FROM edges GROUP BY ALL""",
    ),
)
def _(t):
    store = new_store(t)
    store.write_edges(t.graph()[1], ETYPES)
    return (
        store.read_edges()
        .groupBy(etype_name().alias("etype"))
        .agg(
            F.count(F.lit(1)).alias("num_edges"),
            F.round(F.sum(F.col("edge_weight").cast("decimal(18,2)")).cast("double"), 2).alias("weight"),
        )
    )


@query(
    "mask_index",
    oracle(
        ["masks"],
        """SELECT node_type, CASE WHEN train_mask THEN 'train' WHEN val_mask THEN 'val' ELSE 'test' END AS split,
        node_id FROM masks""",
    ),
)
def _(t):
    store = new_store(t)
    masks = S.split_masks(t.graph()[0].select("node_type", "node_id"))
    out = None
    for split in ("train", "val", "test"):
        store.write_split(masks, split)
        part = store.read_split(split).select("node_type", F.lit(split).alias("split"), "node_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "graph_metadata",
    oracle(
        ["gid", "edges"],
        """SELECT 'hetero_graph' AS graph_name, node_type, count(*) AS num_nodes, min(global_id) AS start_id,
        max(global_id) AS end_id, 64 AS feature_dim, (SELECT count(*) FROM nodes) AS total_nodes,
        (SELECT count(*) FROM edges) AS total_edges, 3 AS num_edge_types, 32 AS num_partitions FROM gid GROUP BY node_type""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    id_map = I.assign_global_ids(nodes, TYPES)
    sizes = I.id_ranges(id_map).join(feature_dims(nodes), "node_type").withColumnRenamed("num_ids", "num_nodes")
    store = new_store(t)
    store.write_metadata(describe_graph(sizes, tables.edge_counts(edges), 32))
    return store.read_metadata().select(
        "graph_name",
        F.inline("node_types"),
        "total_nodes",
        "total_edges",
        F.size("edge_types").alias("num_edge_types"),
        "num_partitions",
    )


@query(
    "feature_dims",
    oracle(
        ["nodes"],
        """SELECT node_type, max(len(feature_vec))::INTEGER AS feature_dim, count(DISTINCT label) AS num_classes
        FROM nodes GROUP BY 1""",
    ),
)
def _(t):
    return feature_dims(t.graph()[0])


@query(
    "graph_stats",
    oracle(
        ["nodes", "edges"],
        """SELECT kind, name, sum(n)::BIGINT AS rows FROM (
          SELECT 'node' AS kind, node_type AS name, count(*) AS n FROM nodes GROUP BY ALL UNION ALL
          SELECT 'edge', src_type || '__' || rel || '__' || dst_type, count(*) FROM edges GROUP BY ALL)
        GROUP BY GROUPING SETS ((kind, name), (kind))""",
    ),
)
def _(t):
    return graph_stats(*t.graph())


_PARTS = """SELECT (node_id % 8)::INTEGER AS partition_id, 'node' AS kind, node_type AS name, count(*) AS rows FROM nodes GROUP BY ALL
  UNION ALL SELECT (src % 8)::INTEGER, 'edge', src_type || '__' || rel || '__' || dst_type, count(*) FROM edges GROUP BY ALL"""


def _partitioned(t, method="mod"):
    nodes, edges = t.graph()
    store = new_store(t)
    placed = P.assign_nodes(nodes, 8, method), P.assign_edges(edges, 8, method)
    store.write_partitions(*placed)
    return store, placed


@query("partition_write", oracle(["nodes", "edges"], _PARTS))
def _(t):
    return _partitioned(t)[0].partition_sizes()


@query(
    "partition_read",
    oracle(
        ["edges"],
        """SELECT (src % 8)::INTEGER AS partition_id, src_type, rel, dst_type, src, dst, edge_weight::DOUBLE AS edge_weight
        FROM edges""",
    ),
)
def _(t):
    # Each partition is read on its own, as its owner would.
    store = _partitioned(t)[0]
    e = reduce(DataFrame.unionByName, [store.read_partition(p)[1] for p in range(8)])
    return e.withColumn("edge_weight", F.col("edge_weight").cast("double"))


@query(
    "partition_audit",
    oracle(
        ["nodes", "edges"],
        f"""SELECT partition_id, kind, name, rows AS expected_rows, rows AS found_rows, true AS complete FROM ({_PARTS})""",
    ),
)
def _(t):
    store, placed = _partitioned(t)
    return P.partition_audit(P.partition_sizes(*placed), store.partition_sizes())


@query(
    "feature_kv",
    oracle(
        ["nodes"],
        f"""SELECT key, ttl, dim, {q4('v')} AS value FROM (SELECT 'gnn:feat:' || node_type || ':' || node_id AS key,
        86400 AS ttl, unnest(range(64)) AS dim, unnest(feature_vec)::DOUBLE AS v FROM nodes)""",
    ),
)
def _(t):
    rows = as_key_values(t.graph()[0]).withColumn("v", decode_vector("value").cast("array<double>"))
    return entries(rows, "v", "key", "ttl")


def _kv_root(t) -> str:
    return f"{checkpoint_root(t.spark)}/hetgraph/kv-{uuid.uuid4().hex}"


@query(
    "kv_sink",
    oracle(
        ["nodes"],
        """SELECT 'gnn:feat:' || node_type || ':' || node_id AS key, CASE WHEN node_id % 3 = 0 THEN 60 ELSE 86400 END AS ttl,
        CASE WHEN node_id % 3 = 0 THEN '[' || node_id || ']' ELSE label::VARCHAR END AS value FROM nodes""",
    ),
)
def _(t):
    # Two commits: every node, then a third of them again.
    root, nodes = _kv_root(t), t.graph()[0]
    key = as_key_values(nodes.withColumn("feature_vec", F.array("node_id"))).withColumn("node_id", F.get_json_object("value", "$[0]").cast("long"))
    first = as_key_values(nodes.select("node_type", "node_id", F.array("label").alias("feature_vec")))
    put_key_values(first.withColumn("value", F.get_json_object("value", "$[0]")), root)
    put_key_values(key.where("node_id % 3 = 0").withColumn("ttl", F.lit(60)), root)
    return read_key_values(t.spark, root)


@query(
    "sync_job",
    oracle(
        ["nodes"],
        f"""SELECT key, ttl, dim, {q4('v')} AS value FROM (SELECT 'gnn:feat:' || node_type || ':' || node_id AS key,
        86400 AS ttl, unnest(range(64)) AS dim, unnest(feature_vec)::DOUBLE AS v FROM nodes)""",
    ),
)
def _(t):
    root = _kv_root(t)
    sync_features_to(t.graph()[0], root)
    rows = read_key_values(t.spark, root).withColumn("v", decode_vector("value").cast("array<double>"))
    return entries(rows, "v", "key", "ttl")


# --- structure ----------------------------------------------------------------------------


@query("edge_index", oracle(["edges"], "SELECT src AS dst, dst AS src FROM edges"))
def _(t):
    return ST.edge_index(t.graph()[1], "dst", "src")


@query(
    "reverse_edges",
    oracle(
        ["edges"],
        """SELECT dst_type AS src_type, 'rev_' || rel AS rel, src_type AS dst_type, dst AS src, src AS dst,
        edge_weight::DOUBLE AS edge_weight FROM edges""",
    ),
)
def _(t):
    e = ST.reverse_edges(t.graph()[1])
    return e.withColumn("edge_weight", F.col("edge_weight").cast("double"))


_ENDS = """SELECT rel, node_id, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, sum(o + i)::BIGINT AS degree
  FROM (SELECT rel, src AS node_id, 1 AS o, 0 AS i FROM gedges UNION ALL SELECT rel, dst, 0, 1 FROM gedges) GROUP BY ALL"""


def _gedges(t):
    nodes, edges = t.graph()
    return I.rewrite_edges(edges, I.assign_global_ids(nodes, TYPES))


@query("super_nodes", oracle(["gedges"], f"SELECT * FROM ({_ENDS}) WHERE degree > 50"))
def _(t):
    return ST.super_nodes(_gedges(t), 50, by=("rel",))


@query("degree_both", oracle(["gedges"], _ENDS))
def _(t):
    return ST.degrees(_gedges(t), "both", by=("rel",))


@query("degree_out", oracle(["edges"], "SELECT src_type, rel, src AS node_id, count(*) AS degree FROM edges GROUP BY ALL"))
def _(t):
    return ST.degrees(t.graph()[1], "out", by=("src_type", "rel"))


@query("degree_in", oracle(["edges"], "SELECT dst_type, rel, dst AS node_id, count(*) AS degree FROM edges GROUP BY ALL"))
def _(t):
    return ST.degrees(t.graph()[1], "in", by=("dst_type", "rel"))


@query(
    "parse_etype",
    oracle(
        ["edges"],
        """SELECT src_type || '__' || rel || '__' || dst_type AS etype, src_type, rel, dst_type, count(*) AS num_edges
        FROM edges GROUP BY ALL""",
    ),
)
def _(t):
    named = t.graph()[1].groupBy(etype_name().alias("etype")).agg(F.count(F.lit(1)).alias("num_edges"))
    return named.withColumn("p", parse_etype("etype")).select("etype", "p.*", "num_edges")


# --- ids ----------------------------------------------------------------------------------


@query("global_ids", oracle(["gid"], "SELECT node_type, node_id, global_id FROM gid"))
def _(t):
    return I.assign_global_ids(t.graph()[0], TYPES)


@query("edge_global_ids", oracle(["gedges"], _GEDGES))
def _(t):
    e = _gedges(t)
    return e.withColumn("edge_weight", F.col("edge_weight").cast("double"))


@query(
    "dangling_edges",
    oracle(
        ["edges"],
        """+known AS (SELECT 'user' AS node_type, c_custkey AS node_id FROM customer WHERE c_acctbal >= 0
          UNION ALL SELECT 'item', p_partkey FROM part WHERE p_size > 5)
        SELECT src_type, rel, dst_type, count_if(s.node_id IS NULL)::BIGINT AS unknown_src,
        count_if(d.node_id IS NULL)::BIGINT AS unknown_dst,
        count_if(s.node_id IS NULL OR d.node_id IS NULL)::BIGINT AS dropped, count(*) AS total
        FROM edges e LEFT JOIN known s ON s.node_type = src_type AND s.node_id = src
        LEFT JOIN known d ON d.node_type = dst_type AND d.node_id = dst GROUP BY ALL""",
    ),
)
def _(t):
    users = t.raw("customer").where("c_acctbal >= 0").select(F.lit("user").alias("node_type"), F.col("c_custkey").alias("node_id"))
    items = t.raw("part").where("p_size > 5").select(F.lit("item").alias("node_type"), F.col("p_partkey").alias("node_id"))
    return I.dangling_edges(t.graph()[1], I.assign_global_ids(users.unionByName(items), TYPES))


@query(
    "distinct_nodes",
    oracle(
        ["edges"],
        "SELECT src_type AS node_type, src AS node_id FROM edges UNION SELECT dst_type, dst FROM edges",
    ),
)
def _(t):
    e = t.graph()[1]
    ends = e.select(F.col("src_type").alias("node_type"), F.col("src").alias("node_id")).unionByName(
        e.select(F.col("dst_type").alias("node_type"), F.col("dst").alias("node_id"))
    )
    return I.distinct_nodes(ends)


@query(
    "node_id_ranges",
    oracle(
        ["gid"],
        "SELECT node_type, min(global_id) AS start_id, max(global_id) AS end_id, count(*) AS num_ids FROM gid GROUP BY 1",
    ),
)
def _(t):
    return I.id_ranges(I.assign_global_ids(t.graph()[0], TYPES))


# --- partitions ---------------------------------------------------------------------------


@query("partition_mod", oracle(["nodes"], "SELECT node_type, node_id, (node_id % 8)::INTEGER AS partition_id FROM nodes"))
def _(t):
    return P.assign_nodes(t.graph()[0].select("node_type", "node_id"), 8, "mod")


_RANDOM_N = f"({h52(42, 'node_type', 'node_id')} % 8)::INTEGER"
_RANDOM_S = f"({h52(42, 'src_type', 'src')} % 8)::INTEGER"
_RANDOM_D = f"({h52(42, 'dst_type', 'dst')} % 8)::INTEGER"


@query("partition_random", oracle(["nodes"], f"SELECT node_type, node_id, {_RANDOM_N} AS partition_id FROM nodes"))
def _(t):
    return P.assign_nodes(t.graph()[0].select("node_type", "node_id"), 8, "random")


def _murmur(k: str) -> list[str]:
    """Steps of the public 32-bit Murmur3 for one word ``k``, as columns over ``h``."""
    times = lambda x, c: f"(({x})::HUGEINT * {c} % 4294967296)::BIGINT"
    turn = lambda x, n: f"((({x} << {n}) | ({x} >> {32 - n})) & 4294967295)"
    return [times(k, 3432918353), times(turn("a", 15), 461845907), turn("xor(h, a)", 13), "(a * 5 + 3864292196) & 4294967295"]


def _hash_sql(n: int) -> str:
    """Spark's hash of a long: both halves, the length, the final mixing."""
    sql = "SELECT node_type, node_id, 42::BIGINT AS h, 0::BIGINT AS a FROM nodes"
    for half in ("node_id & 4294967295", "(node_id >> 32) & 4294967295"):
        for step in _murmur(half):
            sql = f"SELECT node_type, node_id, h, {step} AS a FROM ({sql})"
        sql = f"SELECT node_type, node_id, a AS h, a FROM ({sql})"
    mixed = "xor(h, 8)"
    for shift, factor in ((16, 2246822507), (13, 3266489909), (16, 1)):
        sql = f"SELECT node_type, node_id, ({mixed})::BIGINT AS h FROM ({sql})"
        mixed = f"(xor(h, h >> {shift})::HUGEINT * {factor} % 4294967296)::BIGINT"
    # The number of partitions divides 2 ** 32, so the sign does not matter.
    return f"SELECT node_type, node_id, ({mixed} % {n})::INTEGER AS partition_id FROM ({sql})"


@query("partition_hash", oracle(["nodes"], _hash_sql(8)))
def _(t):
    return P.assign_nodes(t.graph()[0].select("node_type", "node_id"), 8, "hash")


@query(
    "partition_edges",
    oracle(["edges"], f"SELECT src_type, rel, dst_type, src, dst, {_RANDOM_S} AS partition_id FROM edges"),
)
def _(t):
    return P.assign_edges(t.graph()[1].drop("edge_weight"), 8, "random")


@query(
    "edge_partition",
    oracle(
        ["edges"],
        """SELECT e.src_type, e.rel, e.dst_type, e.src, e.dst, (c_nationkey)::INTEGER AS partition_id
        FROM edges e JOIN customer ON c_custkey = src WHERE src_type = 'user'
        UNION ALL SELECT e.src_type, e.rel, e.dst_type, e.src, e.dst, (p_partkey % 25)::INTEGER
        FROM edges e JOIN part ON p_partkey = src WHERE src_type = 'item'""",
    ),
)
def _(t):
    owner = t.raw("customer").select(
        F.lit("user").alias("node_type"), F.col("c_custkey").alias("node_id"), F.col("c_nationkey").cast("int").alias("partition_id")
    )
    items = t.raw("part").select(
        F.lit("item").alias("node_type"), F.col("p_partkey").alias("node_id"), (F.col("p_partkey") % 25).cast("int").alias("partition_id")
    )
    owner = owner.unionByName(items)
    e = P.follow_source(t.graph()[1], owner)
    return e.select("src_type", "rel", "dst_type", "src", "dst", "partition_id")


@query(
    "partition_stats",
    oracle(
        ["nodes", "edges"],
        f"""SELECT {_RANDOM_N} AS partition_id, 'node' AS kind, node_type AS name, count(*) AS rows FROM nodes GROUP BY ALL
        UNION ALL SELECT {_RANDOM_S}, 'edge', src_type || '__' || rel || '__' || dst_type, count(*) FROM edges GROUP BY ALL""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    return P.partition_sizes(P.assign_nodes(nodes, 8), P.assign_edges(edges, 8))


@query(
    "halo_nodes",
    oracle(
        ["edges"],
        f"""SELECT DISTINCT * FROM (SELECT {_RANDOM_S} AS partition_id, dst_type AS node_type, dst AS node_id,
        {_RANDOM_D} AS owner_id FROM edges) WHERE partition_id <> owner_id""",
    ),
)
def _(t):
    return P.halo_nodes(t.graph()[1], 8)


_LOCAL = f"""+own AS (SELECT DISTINCT (node_id % 8)::BIGINT AS partition_id, node_type, node_id, false AS halo FROM nodes),
  far AS (SELECT DISTINCT (src % 8)::BIGINT AS partition_id, dst_type AS node_type, dst AS node_id, true AS halo FROM edges e
    SEMI JOIN own s ON s.node_type = e.src_type AND s.node_id = e.src
    SEMI JOIN own d ON d.node_type = e.dst_type AND d.node_id = e.dst WHERE src % 8 <> dst % 8),
  members AS MATERIALIZED (SELECT partition_id, node_type, node_id, row_number() OVER (PARTITION BY partition_id, node_type ORDER BY halo, node_id) - 1 AS local_id
    FROM (SELECT * FROM own UNION ALL SELECT * FROM far))"""


@query(
    "partition_local",
    oracle(["nodes", "edges"], f"{_LOCAL} SELECT partition_id, node_type, local_id, node_id, (node_id % 8)::BIGINT AS owner_id FROM members"),
)
def _(t):
    return P.local_graph(*t.graph(), 8, "mod").members


@query(
    "partition_local_edges",
    oracle(
        ["nodes", "edges"],
        f"""{_LOCAL} SELECT s.partition_id, e.src_type, e.rel, e.dst_type, s.local_id AS src, d.local_id AS dst, 2::BIGINT AS dims,
        {q4('e.edge_weight::DOUBLE * 1.5')} AS vec_sum FROM edges e
        JOIN members s ON s.partition_id = e.src % 8 AND s.node_type = e.src_type AND s.node_id = e.src
        JOIN members d ON d.partition_id = e.src % 8 AND d.node_type = e.dst_type AND d.node_id = e.dst""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    vectors = edges.withColumn("feature_vec", F.array(F.col("edge_weight"), F.col("edge_weight") / 2).cast("array<float>"))
    local = P.local_graph(nodes, vectors.drop("edge_weight"), 8, "mod").edges
    return vec_digest(local, "partition_id", "src_type", "rel", "dst_type", "src", "dst")


@query(
    "edge_cut",
    oracle(
        ["edges"],
        f"""SELECT src_type, rel, dst_type, count(*) AS num_edges, count_if({_RANDOM_S} <> {_RANDOM_D})::BIGINT AS cut_edges,
        count_if({_RANDOM_S} <> {_RANDOM_D})::DOUBLE / count(*)::DOUBLE AS cut_ratio FROM edges GROUP BY ALL""",
    ),
)
def _(t):
    return P.edge_cut(t.graph()[1], 8)


_BALANCED = """+ends AS (SELECT src_type AS node_type, src AS node_id FROM edges UNION ALL SELECT dst_type, dst FROM edges),
  w AS (SELECT n.node_type, n.node_id, greatest(count(e.node_id), 1) AS weight
    FROM (SELECT DISTINCT node_type, node_id FROM nodes) n LEFT JOIN ends e USING (node_type, node_id) GROUP BY ALL),
  p AS (SELECT *, sum(weight) OVER (ORDER BY node_type, node_id) - weight AS before, sum(weight) OVER () AS total FROM w)
SELECT node_type, node_id, weight, (before * 8 // total)::INTEGER AS partition_id FROM p"""


@query("partition_balanced", oracle(["nodes", "edges"], _BALANCED))
def _(t):
    nodes, edges = t.graph()
    return P.balanced_map(edges, nodes, 8)


_BALANCED_ENDS = _BALANCED.replace("SELECT node_type, node_id, weight, (before", ", owner AS (SELECT node_type, node_id, (before") + """),
  placed AS (SELECT e.src_type, e.rel, e.dst_type, e.dst, a.partition_id, b.partition_id AS owner_id FROM edges e
    JOIN owner a ON a.node_type = e.src_type AND a.node_id = e.src JOIN owner b ON b.node_type = e.dst_type AND b.node_id = e.dst)"""


def _balanced_owner(t):
    nodes, edges = t.graph()
    return edges, materialize(P.balanced_map(edges, nodes, 8).drop("weight"), "owner")


@query(
    "halo_balanced",
    oracle(
        ["nodes", "edges"],
        _BALANCED_ENDS
        + "SELECT DISTINCT partition_id, dst_type AS node_type, dst AS node_id, owner_id FROM placed WHERE partition_id <> owner_id",
    ),
)
def _(t):
    edges, owner = _balanced_owner(t)
    return P.halo_nodes(edges, owner=owner)


@query(
    "cut_balanced",
    oracle(
        ["nodes", "edges"],
        _BALANCED_ENDS
        + """SELECT src_type, rel, dst_type, count(*) AS num_edges, count_if(partition_id <> owner_id)::BIGINT AS cut_edges,
        count_if(partition_id <> owner_id)::DOUBLE / count(*)::DOUBLE AS cut_ratio FROM placed GROUP BY ALL""",
    ),
)
def _(t):
    edges, owner = _balanced_owner(t)
    return P.edge_cut(edges, owner=owner)


@query(
    "partition_cutaware",
    oracle(
        ["nodes", "edges"],
        _BALANCED.replace("SELECT node_type, node_id, weight, (before * 8 // total)::INTEGER AS partition_id FROM p", "")
        + "SELECT node_type, node_id, weight, true AS placed, true AS quota_kept, true AS cuts_less FROM p",
    ),
)
def _(t):
    # Every node once with its weight; the map itself has no SQL, so its quota and cut are audited.
    nodes, edges = t.graph()
    edges = materialize(edges.select("src_type", "rel", "dst_type", "src", "dst"), "edges")
    before = materialize(P.balanced_map(edges, nodes, 8), "before")
    owner = materialize(cut_aware_map(edges, nodes, 8, rounds=4, start=before), "owner")
    cuts = P.cut_totals(edges, {"before": before, "after": owner}).first()

    def most(held):
        return held.groupBy("partition_id").agg(F.sum("weight").alias("load")).agg(F.max("load")).scalar()

    total = owner.agg(F.sum("weight")).scalar()
    quota = F.greatest(F.floor(total * 1.05 / 8), most(before))
    return owner.select(
        "node_type", "node_id", "weight", F.col("partition_id").between(0, 7).alias("placed"),
        (most(owner) <= quota).alias("quota_kept"), F.lit(cuts.after < cuts.before).alias("cuts_less"),
    )


@query(
    "partition_job",
    oracle(
        ["nodes", "edges"],
        f"""SELECT partition_id, kind, name, rows AS expected_rows, rows AS found_rows, true AS complete FROM ({_PARTS})""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    store = new_store(t)
    with store.snapshot():
        store.write_nodes(nodes.withColumn("global_id", F.col("node_id")), TYPES)
        store.write_edges(edges, ETYPES)
    return partition_graph(store, 8, "mod")["audit"]


@query(
    "partition_map",
    oracle(["gid"], f"SELECT node_type, global_id AS node_id, ({h52(42, 'node_type', 'global_id')} % 32)::INTEGER AS partition_id FROM gid"),
)
def _(t):
    ids = I.assign_global_ids(t.graph()[0], TYPES)
    return P.assign_nodes(ids.select("node_type", F.col("global_id").alias("node_id")), 32)


@query(
    "partition_config",
    oracle(
        ["nodes", "edges"],
        f"""SELECT 8 AS num_parts, 'mod' AS part_method, partition_id, kind, name, rows,
        (SELECT count(*) FROM nodes) AS total_nodes FROM ({_PARTS})""",
    ),
)
def _(t):
    nodes, edges = t.graph()
    sizes = P.partition_sizes(P.assign_nodes(nodes, 8, "mod"), P.assign_edges(edges, 8, "mod"))
    config = P.partition_config(sizes, 8, "mod", "parts").select(F.from_json("config", P.PARTITION_CONFIG).alias("c"))
    total = F.aggregate(F.map_values("c.num_nodes"), F.lit(0).cast("long"), lambda a, x: a + x)
    stats = config.select("c.num_parts", "c.part_method", total.alias("total_nodes"), F.explode("c.partition_stats").alias("s"))
    sides = [
        stats.select(
            "num_parts", "part_method", "s.partition_id", F.lit(kind).alias("kind"),
            F.explode(f"s.num_{kind}s").alias("name", "rows"), "total_nodes",
        )
        for kind in ("node", "edge")
    ]
    return sides[0].unionByName(sides[1])


@query(
    "placement",
    oracle(
        ["nodes"],
        f"""+sizes AS (SELECT ({h52(42, 'node_type', 'node_id')} % 64)::INTEGER AS partition_id, count(*) AS rows FROM nodes GROUP BY 1)
        SELECT partition_id, rows, n_name AS host, n_name IS NOT NULL AS placed
        FROM sizes LEFT JOIN nation ON n_nationkey = partition_id // 2""",
    ),
)
def _(t):
    sizes = P.assign_nodes(t.graph()[0], 64).groupBy("partition_id").agg(F.count(F.lit(1)).alias("rows"))
    hosts = t.raw("nation").select(F.col("n_nationkey").cast("long").alias("host_index"), F.col("n_name").alias("host"))
    return P.placement(sizes, hosts, per_host=2)


@query(
    "etl_stats",
    oracle(
        ["nodes", "gedges"],
        """SELECT 'node' AS kind, node_type AS name, count(*) AS rows FROM nodes GROUP BY ALL
        UNION ALL SELECT 'edge', src_type || '__' || rel || '__' || dst_type, count(*) FROM gedges GROUP BY ALL""",
    ),
)
def _(t):
    path = f"{checkpoint_root(t.spark)}/hetgraph/etl-{uuid.uuid4().hex}"
    config = GraphConfig(output_path=path, num_partitions=8)
    export_graph(t.spark, t, config, SNAPSHOT)
    latest = GraphStore(t.spark, path).read_metadata()
    return latest.select(F.inline("node_types")).select(
        F.lit("node").alias("kind"), F.col("node_type").alias("name"), F.col("num_nodes").alias("rows")
    ).unionByName(
        latest.select(F.inline("edge_types")).select(
            F.lit("edge").alias("kind"), F.col("etype").alias("name"), F.col("num_edges").alias("rows")
        )
    )
