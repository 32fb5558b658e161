"""Where the named queries and their checks are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hetgraph.runtime import tune
from hetgraph.sources.fixtures import DriverTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame``, with the SQL that must give the same rows."""

    def wrap(f: Callable[[DriverTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # as the SQL reads timestamps
            return f(DriverTables(tune(spark), sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return wrap


def r4(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def entries(df: DataFrame, vec: str, *keys: str, name: str = "value") -> DataFrame:
    """One row per vector entry, rounded."""
    return df.select(*keys, F.posexplode(vec).alias("dim", "__v")).select(
        *keys, F.col("dim").cast("long").alias("dim"), r4("__v").alias(name)
    )
