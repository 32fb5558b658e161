"""The driver's star-schema tables seen as node and edge tables of a user-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.schema import GraphConfig
from hetgraph.sources.tables import scan_graph

SNAPSHOT = "2024-01-01"
CONFIG = GraphConfig()


class DriverTables:
    """Named node and edge tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def _with_vectors(self, ids: DataFrame, key) -> DataFrame:
        emb = self.raw("embeddings")
        size = emb.select(F.count(F.lit(1))).scalar()
        return (
            ids.select("node_id", (key % size).alias("vec_id"))
            .join(emb, "vec_id")
            .select(
                "node_id",
                F.col("embedding").alias("feature_vec"),
                "label",
                F.lit(SNAPSHOT).alias("dt"),
            )
        )

    def nodes_user(self) -> DataFrame:
        ids = self.raw("customer").select(F.col("c_custkey").alias("node_id"))
        return self._with_vectors(ids, F.col("node_id"))

    def nodes_item(self) -> DataFrame:
        ids = self.raw("part").select(F.col("p_partkey").alias("node_id"))
        return self._with_vectors(ids, F.col("node_id") * 7 + 3)

    def edges_purchase(self) -> DataFrame:
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return (
            self.raw("lineitem")
            .join(orders, "l_orderkey")
            .select(
                F.col("o_custkey").alias("src_node_id"),
                F.col("l_partkey").alias("dst_node_id"),
                F.lit("user").alias("src_type"),
                F.lit("item").alias("dst_type"),
                F.col("l_quantity").cast("float").alias("edge_weight"),
                F.lit(SNAPSHOT).alias("dt"),
            )
        )

    def edges_click(self) -> DataFrame:
        return (
            self.raw("events")
            .where(F.col("event_type") == "click")
            .select(
                F.col("user_id").alias("src_node_id"),
                F.get_json_object("props", "$.k").cast("long").alias("dst_node_id"),
                F.lit("user").alias("src_type"),
                F.lit("item").alias("dst_type"),
                F.col("value").cast("float").alias("edge_weight"),
                F.lit(SNAPSHOT).alias("dt"),
            )
        )

    def edges_similar(self) -> DataFrame:
        # One edge per line item, row by row: no pairs within an order are formed.
        parts = self.raw("part").select(F.count(F.lit(1))).scalar()
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("src_node_id"),
            ((F.col("l_partkey") + F.col("l_suppkey")) % parts).alias("dst_node_id"),
            F.lit("item").alias("src_type"),
            F.lit("item").alias("dst_type"),
            F.col("l_discount").cast("float").alias("edge_weight"),
            F.lit(SNAPSHOT).alias("dt"),
        )

    def graph(self) -> tuple[DataFrame, DataFrame]:
        """Long node and edge tables of the snapshot."""
        return scan_graph(self, CONFIG, SNAPSHOT)
