"""Neighbours against brute force."""

import math

import numpy as np

from hetgraph.llm import ann as A


def brute(rows, step, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, v)
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids], float)
    out = {}
    for i in ids[ids % step == 0]:
        s = sum(x[:, d] * good[i][d] for d in range(x.shape[1]))
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def of(df):
    out = {}
    for r in sorted(df.collect()):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_recall_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()], 20, 20)
    got = of(A.search(table, "vec_id % 20 = 0"))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    exact = {q: dict(v) for q, v in want.items()}
    for q, found in got.items():
        assert [v for v, _ in found] == [v for v, s in sorted(found, key=lambda x: (-x[1], x[0]))]
        assert all(exact[q].get(v, s) == s for v, s in found)


def test_no_query_comes_back_short(spark):
    """Tight clusters, so that many leaves hold fewer rows than a query wants."""
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(400, 16))
    x = np.repeat(middle, 25, axis=0) + rng.normal(size=(10_000, 16)) * 0.01
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    rows = [(i, v) for i, v in enumerate(x[rng.permutation(10_000)].tolist())]
    assert A.grow(A._even_length(x, 1 + 1e-9), 10_000).leaves > 100
    got = of(A.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 20 = 0"))
    want = brute(rows, 20, 20)
    assert set(got) == set(want) and {len(v) for v in got.values()} == {20}
    assert recall(got, want) >= 0.9


def test_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(3000)]  # one very common vector
    rows += [(5000, None), (5020, [0.0] * 8), (5040, [None] + [1.0] * 7), (5060, [math.nan] * 8), (5080, [math.inf] + [1.0] * 7)]
    rows += [(None, [1.0] * 8), (5100, []), (5120, [1.0] * 3), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, leaf int, rank int")
    got = of(A.search(table, "vec_id % 20 = 0"))
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 8], 20, 20)
    assert set(got) == set(want)
    assert all(got[q] == want[q] for q in want if q >= 1000)
    assert recall(got, want) >= 0.9
    few = of(A.search(table.where("vec_id < 15"), "vec_id % 20 = 0"))
    assert few == brute(rows[:15], 20, 20) and len(few[0]) == 14
    assert A.search(table.limit(0), "vec_id % 20 = 0").collect() == []
    assert A.search(table.where("vec_id = 3"), "vec_id % 20 = 0").collect() == []


def test_visits_are_all_leaves_once():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    tree = A.grow(x, 3000, branches=4, leaf_rows=50)
    assert tree.leaves > 40
    assert sorted(tree.visits(x[0], tree.leaves)) == list(range(tree.leaves))
    leaf = tree.leaf_of(x)
    first = [tree.visits(v, 3).index(n) if n in tree.visits(v, 3) else 9 for v, n in zip(x[:200], leaf)]
    assert np.mean(np.array(first) == 0) > 0.6


def test_bins_follow_the_tree():
    rows = np.array([5, 3, 3, 20, 0, 0, 4, 6, 1])
    assert A.bins_of(rows, 10).tolist() == [0, 0, 1, 2, 3, 3, 3, 3, 4]
    assert A.bins_of(np.zeros(0, int), 10).tolist() == []
