"""Reading graphs that other jobs wrote with one plain directory per type."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.schema import EdgeType

# Column names used by the two known writers, first match wins.
_NODE_COLUMNS = {"node_id": ("node_id", "global_node_id"), "feature_vec": ("feat", "feature_vec"), "label": ("label",)}
_EDGE_COLUMNS = {"src": ("src_id", "src"), "dst": ("dst_id", "dst"), "edge_weight": ("weight", "edge_weight")}


def _only_missing(fault: AnalysisException) -> None:
    """A folder that is not there may be skipped; any other fault is one."""
    if fault.getCondition() != "PATH_NOT_FOUND":
        raise fault


def read_metadata_text(spark: SparkSession, root: str) -> DataFrame:
    """``metadata.json``, else the parts of ``metadata_temp``, as one text row ``value``."""
    for path in (f"{root}/metadata.json", f"{root}/metadata_temp/part-*"):
        try:
            text = spark.read.text(path, wholetext=True)
        except AnalysisException as e:
            _only_missing(e)
            continue
        return text.where(F.length(F.trim("value")) > 0)
    raise FileNotFoundError(f"no metadata under {root}")


def metadata_edge_types(text: DataFrame, value: str = "value") -> DataFrame:
    """Edge types out of metadata text; an entry may be an object or a list of three names."""
    entries = text.select(F.explode(F.from_json(F.get_json_object(value, "$.edge_types"), "array<string>")).alias("e"))
    triple = F.from_json("e", "array<string>")
    named = F.from_json("e", "src_type string, rel_type string, edge_name string, dst_type string")
    is_list = F.col("e").startswith("[")
    return entries.select(
        F.when(is_list, F.get(triple, F.lit(0))).otherwise(named["src_type"]).alias("src_type"),
        F.when(is_list, F.get(triple, F.lit(1)))
        .otherwise(F.coalesce(named["rel_type"], named["edge_name"]))
        .alias("rel"),
        F.when(is_list, F.get(triple, F.lit(2))).otherwise(named["dst_type"]).alias("dst_type"),
    )


def metadata_node_types(text: DataFrame, value: str = "value") -> DataFrame:
    return text.select(
        F.explode(F.from_json(F.get_json_object(value, "$.node_types"), "array<string>")).alias("node_type")
    )


def _pick(df: DataFrame, wanted: dict[str, tuple[str, ...]]) -> list:
    out = []
    for name, known in wanted.items():
        found = next((c for c in known if c in df.columns), None)
        if found:
            out.append(F.col(found).alias(name))
    return out


def read_type_dirs(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Long node and edge tables; a missing directory is skipped, optional columns may be absent."""
    text = read_metadata_text(spark, root)
    nodes, edges = [], []
    # Type names come from one small file.
    for r in metadata_node_types(text).collect():
        try:
            df = spark.read.parquet(f"{root}/node_data/{r.node_type}")
        except AnalysisException as e:
            _only_missing(e)
            continue
        nodes.append(df.select(F.lit(r.node_type).alias("node_type"), *_pick(df, _NODE_COLUMNS)))
    for r in metadata_edge_types(text).collect():
        etype = EdgeType(r.src_type, r.rel, r.dst_type)
        for name in (etype.name, "_".join(etype)):
            try:
                df = spark.read.parquet(f"{root}/edge_data/{name}")
            except AnalysisException as e:
                _only_missing(e)
                continue
            ends = [F.lit(v).alias(c) for c, v in zip(("src_type", "rel", "dst_type"), etype)]
            edges.append(df.select(*ends, *_pick(df, _EDGE_COLUMNS)))
            break
    join = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None
    return join(nodes), join(edges)
