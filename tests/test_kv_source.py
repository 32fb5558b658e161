"""The key-value sink as a data source with a commit."""

import glob

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hetgraph.sinks import kv_source as K


def _rows(spark, root, **options):
    return sorted(map(tuple, K.read_key_values(spark, root, **options).collect()), key=str)


def test_later_commits_win_and_keys_expire(spark, tmp_path):
    root = str(tmp_path)
    assert _rows(spark, root) == []
    kv = lambda rows: spark.createDataFrame(rows, "key string, ttl int, value string, more int")
    K.put_key_values(kv([("a", 10, "1", 0), ("b", 100, "2", 0), ("a", 10, "3", 0), (None, 1, "x", 0), ("n", 100, None, 0)]).repartition(3), root, at=1000)
    K.put_key_values(kv([("b", 5, "0", 0)]), root, at=1050)
    K.put_key_values(kv([]), root, at=1060)
    assert _rows(spark, root) == [("a", 10, "3"), ("b", 5, "0"), ("n", 100, None)]
    assert _rows(spark, root, now=1054) == [("b", 5, "0"), ("n", 100, None)]
    assert _rows(spark, root, now=1055) == [("n", 100, None)]
    with pytest.raises(Exception, match="appended"):
        kv([]).drop("more").write.format(K.NAME).mode("overwrite").option("root", root).save()


def test_a_failed_write_shows_nothing(spark, tmp_path):
    root = str(tmp_path)
    K.put_key_values(spark.createDataFrame([("a", 1, "old")], K.SCHEMA), root)
    rows = spark.range(40).repartition(4).select(
        F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit(1).alias("ttl"),
        F.when(F.col("id") == 17, F.raise_error(F.lit("broken"))).otherwise(F.lit("new")).alias("value"),
    )
    with pytest.raises(Exception):
        K.put_key_values(rows, root)
    assert _rows(spark, root) == [("a", 1, "old")]
    assert len(glob.glob(f"{root}/commits/*.json")) == 1
    # Segments that no commit names, as a lost or repeated task leaves them, are not read.
    named = glob.glob(f"{root}/segments/*/*.parquet")
    assert len(named) == 1
    spark.createDataFrame([("z", 1, "stray")], K.SCHEMA).coalesce(1).write.parquet(f"{root}/segments/stray")
    assert _rows(spark, root) == [("a", 1, "old")]


def test_tasks_that_fail_or_end_after_an_abort_leave_no_segment(tmp_path):
    root = str(tmp_path)
    batch = pa.RecordBatch.from_pylist([{"key": "k", "ttl": 1, "value": "v"}], K._ARROW)
    files = lambda: [f for f in glob.glob(f"{root}/segments/**", recursive=True, include_hidden=True) if f.endswith((".parquet", ".tmp"))]

    def broken(writer):
        yield batch
        raise ValueError("broken")

    def late(writer):
        yield batch
        writer.abort([])
        yield batch

    def later(writer):
        writer.abort([])
        yield batch

    for rows in (broken, late, later):
        writer = K._Writer({"root": root})
        with pytest.raises(Exception):
            writer.write(rows(writer))
        assert files() == [], rows.__name__
    # The abort may come between the last look and the move as well.
    writer = K._Writer({"root": root})
    looks = iter([lambda: None, lambda: writer.abort([])])
    go_on = writer._go_on
    writer._go_on = lambda *a: (next(looks)(), go_on(*a))
    with pytest.raises(RuntimeError, match="aborted"):
        writer.write(iter([batch]))
    assert files() == []
    writer = K._Writer({"root": root})
    staged = writer.write(iter([batch, batch]))
    assert staged.rows == 2 and files() == [f"{root}/segments/{writer.job}/{staged.segment}"]
