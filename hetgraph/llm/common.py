"""What several of the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.runtime import materialize

#: Everything that is not one of the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str = "text"):
    """The text as bytes; a null text is an empty one."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def arrow_map(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from column dicts to column dicts.

    ``rows`` gets one dict of Arrow arrays per batch and yields dicts of columns in the order of
    ``schema``. It must not keep batches.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = df.sparkSession.createDataFrame([], schema)
    target = to_arrow_schema(empty.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dicts = (dict(zip(b.schema.names, b.columns)) for b in batches if b.num_rows)
        for out in rows(dicts):
            arrays = [
                v.cast(f.type) if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type)
                for v, f in zip(out.values(), target)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def list_array(parts: list[np.ndarray], dtype: str) -> pa.Array:
    """A list column from one numpy array per row."""
    ends = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat.astype(dtype, copy=False))).cast(
        pa.list_(pa.from_numpy_dtype(dtype))
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected links ``(a, b)``, both long.

    The nodes have a hashed order. Each round every node moves to the first of itself and its neighbours,
    then to where that one moves, and the links are contracted. As the order is random, a constant share of the nodes
    that still have links goes away, also on chains: the number of rounds is logarithmic, and two
    for a hub. A hub costs one partial aggregation and joins whose hot side Spark may split. Null
    ends and loops are ignored; no links give no rows. The component's name is its smallest node.
    """
    order = lambda c: F.xxhash64(F.col(c))
    links = materialize(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    empty = links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    rounds = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        once = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", order("b")).alias("first")).select(
            "node", F.when(order("first") < order("node"), F.col("first")).otherwise(F.col("node")).alias("to")
        )
        moves = materialize(
            once.join(once.toDF("to", "further"), "to").select("node", F.col("further").alias("to")), "moves"
        )
        rounds.append(moves)
        end_a, end_b = moves.toDF("a", "ra"), moves.toDF("b", "rb")
        links = materialize(
            links.join(end_a, "a").join(end_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "links",
        )
    if not rounds:
        return empty
    names = rounds[0].toDF("node", "component")
    for moves in rounds[1:]:
        names = names.join(moves.toDF("component", "to"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    smallest = names.groupBy("component").agg(F.min("node").alias("smallest"))
    return materialize(
        names.join(smallest, "component").select("node", F.col("smallest").alias("component")), "components"
    )


def process_store(name: str) -> dict:
    """A dict that lives as long as the worker process, so that tasks share what they have loaded."""
    import sys
    import types

    module = sys.modules.setdefault("_training_data_store", types.ModuleType("_training_data_store"))
    return module.__dict__.setdefault(name, {})
