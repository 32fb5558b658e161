"""Every named query against its SQL check on the smallest data folder."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from conftest import SF

ORACLES = entry.oracle_sql()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = df.collect()
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        cols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(cols)
        types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cur.description}
        assert dict(df.dtypes) == types
        assert rows_of(df.columns, got) == rows_of(cols, cur.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rel", "dst", "n", "dim", "value"]
