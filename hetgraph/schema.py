"""Table schemas, edge types and job configuration."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("feature_vec", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("dt", T.StringType()),
    ]
)

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("src_node_id", T.LongType()),
        T.StructField("dst_node_id", T.LongType()),
        T.StructField("src_type", T.StringType()),
        T.StructField("dst_type", T.StringType()),
        T.StructField("edge_weight", T.FloatType()),
        T.StructField("dt", T.StringType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("node_type", T.StringType()),
        T.StructField("task_type", T.StringType()),
    ]
)

# The columns that identify an edge type in a long edge table.
ETYPE = ["src_type", "rel", "dst_type"]


class EdgeType(NamedTuple):
    src_type: str
    rel: str
    dst_type: str

    @property
    def name(self) -> str:
        return "__".join(self)

    def reverse(self) -> "EdgeType":
        return EdgeType(self.dst_type, f"rev_{self.rel}", self.src_type)


def etype_name(src_type="src_type", rel="rel", dst_type="dst_type") -> Column:
    """Stored name of an edge type, ``src__rel__dst``."""
    return F.concat_ws("__", F.col(src_type), F.col(rel), F.col(dst_type))


def is_etype(etypes) -> Column:
    """Predicate for a list of edge types, one comparison per column."""
    match = F.lit(False)
    for e in map(EdgeType._make, etypes):
        match = match | ((F.col("src_type") == e.src_type) & (F.col("rel") == e.rel) & (F.col("dst_type") == e.dst_type))
    return match


def parse_etype(name: str | Column) -> Column:
    """Struct of the three parts, null when the name has not exactly three."""
    parts = F.split(F.col(name) if isinstance(name, str) else name, "__")
    return F.when(
        F.size(parts) == 3,
        F.struct(
            parts[0].alias("src_type"), parts[1].alias("rel"), parts[2].alias("dst_type")
        ),
    )


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Select and cast the declared columns; a missing required one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns]
    )


@dataclass(frozen=True)
class GraphConfig:
    """What one extract-and-export job reads and writes."""

    node_types: tuple[str, ...] = ("user", "item")
    edge_types: tuple[EdgeType, ...] = (
        EdgeType("user", "click", "item"),
        EdgeType("user", "purchase", "item"),
        EdgeType("item", "similar", "item"),
    )
    database: str = "graph_db"
    output_path: str = "/data/graph"
    num_partitions: int = 32
    graph_name: str = "hetero_graph"
    num_classes: int | None = None
    # Add the swapped copy of every edge type, so that a source-only type also receives messages.
    with_reverse: bool = False

    def __post_init__(self):
        object.__setattr__(self, "edge_types", tuple(EdgeType(*e) for e in self.edge_types))
        if self.num_partitions < 1:
            raise ValueError("num_partitions must be positive")


@dataclass(frozen=True)
class TrainConfig:
    """Model and training settings with the usual defaults."""

    model_type: str = "sage"
    hidden_channels: int = 256
    num_layers: int = 3
    num_heads: int = 4
    num_classes: int = 10
    target_node_type: str = "user"
