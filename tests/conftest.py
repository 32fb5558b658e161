import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hetgraph.runtime import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", cpus=8, shuffle=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ck"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def graph(spark):
    from hetgraph.sources.fixtures import DriverTables

    return DriverTables(spark, SF).graph()


NODES = "node_type string, node_id long, feature_vec array<float>, label int"
EDGES = "src_type string, rel string, dst_type string, src long, dst long, edge_weight float"


@pytest.fixture(scope="session")
def small(spark):
    """Ten nodes, three edge types, with parallel edges, a self loop, and nodes without edges."""
    import numpy as np

    rng = np.random.default_rng(3)
    nodes = [("user", i, [float(x) for x in rng.normal(size=5)], i % 2) for i in range(4)]
    nodes += [("item", i, [float(x) for x in rng.normal(size=7)], i % 3) for i in range(6)]
    pairs = {
        ("user", "click", "item"): [(0, 0), (0, 0), (1, 0), (2, 3), (1, 4)],
        ("item", "similar", "item"): [(0, 1), (1, 0), (3, 3), (4, 0)],
        ("item", "sold_to", "user"): [(0, 0), (1, 0), (2, 1), (4, 1), (4, 1)],
    }
    edges = [(*t, s, d, 1.0) for t, ps in pairs.items() for s, d in ps]
    return (
        spark.createDataFrame(nodes, NODES),
        spark.createDataFrame(edges, EDGES),
        {(t, i): np.array(v) for t, i, v, _ in nodes},
        pairs,
    )
