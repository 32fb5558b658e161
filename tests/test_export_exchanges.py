"""What an export moves."""

import glob

from pyspark.sql import DataFrame

from hetgraph.plans.jobs import export_graph
from hetgraph.schema import GraphConfig
from hetgraph.sinks.store import GraphStore
from hetgraph.sources.fixtures import SNAPSHOT, DriverTables


def test_rows_out_of_the_joins_are_written_as_they_lie(spark, tmp_path, monkeypatch):
    asked = []
    hint = DataFrame.hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *more: asked.append(name) or hint(self, name, *more))
    stats = export_graph(spark, DriverTables(spark, "/root/testdata/sf0.001"), GraphConfig(output_path=str(tmp_path)), SNAPSHOT)
    assert "rebalance" not in asked
    store = GraphStore(spark, str(tmp_path)).pinned()
    assert stats["total_edges"] == store.read_edges().count() == 12_000 + sum(n for e, n in stats["edge_types"].items() if "click" in e)
    assert stats["total_nodes"] == store.read_nodes().count() == 350
    assert len(glob.glob(f"{tmp_path}/edge_data/*/*/*.parquet")) <= 3 * 8 * 4
