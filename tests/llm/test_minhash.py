"""Near-duplicates against brute force."""

import math
import re

import numpy as np
import pytest

from hetgraph.llm import minhash as M
from hetgraph.llm.common import components

SF = "/root/testdata/sf0.01"


def brute(rows, words, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        k = min(words, len(w))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    for d, s in sets.items():
        counts = {}
        for x in s:
            for o in by[x]:
                if o < d:
                    counts[o] = counts.get(o, 0) + 1
        for o, n in counts.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


@pytest.mark.parametrize("words", [2, 5])
def test_whole_table(spark, words):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, M.near_duplicates(docs, words=words).collect()))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], words, 80)


def test_edges(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 400, 300)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two\n"), (8, "É x"), (9, "é x")]
    for i in range(40):  # a large group of near copies, and a chain that drifts away
        w = list(base)
        for j in rng.integers(0, 300, 6):
            w[j] = f"n{i}_{j}"
        rows.append((100 + i, " ".join(w)))
    drift = [f"d{i}" for i in range(200)]
    for i in range(30):
        drift[i * 6 : i * 6 + 6] = [f"e{i}_{k}" for k in range(6)]
        rows.append((200 + i, " ".join(drift)))
    rows += [(300 + i, " ".join(base)) for i in range(20)]
    docs = spark.createDataFrame([(d, t, d, "x") for d, t in rows], "doc_id long, text string, node long, component_id string")
    got = sorted(map(tuple, M.near_duplicates(docs, words=2).collect()))
    assert got == brute(rows, 2, 80)
    assert M.near_duplicates(docs.limit(0), words=2).collect() == []
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (0, "q")], "doc_id long, text string")
    got = sorted(map(str, M.near_duplicates(twice, words=2).collect()))
    assert len(got) == 4 and sum("component_id=1" in x for x in got) == 2
    assert sorted(map(str, M.keep_one(twice).collect())) == sorted(
        map(str, spark.createDataFrame([(1, "a b c"), (0, "q")], "doc_id long, text string").collect())
    )


def test_keep_one_goes_by_id_and_text(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    near = a.rsplit(" ", 1)[0]
    rows = [(1, b, 0), (1, a, 1), (2, near, 2), (None, a, 3), (None, near, 4), (None, "c d e", 5), (None, "c d e", 6)]
    rows += [(9, None, 7), (8, "", 8), (8, "", 9), (None, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    got = sorted(r.extra for r in M.keep_one(docs).collect())
    # Both texts of id 1; one of the two null rows; one of the two empty rows of id 8.
    assert got in [[0, 1, x, 7, y, 10] for x in (5, 6) for y in (8, 9)]
    assert M.keep_one(docs.limit(0)).collect() == []


def test_sketch_is_fair():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for n in (1, 7, 90, 1800):
        a, b = np.unique(pool[: int(n * 0.9) or 1]), np.unique(pool[int(n * 0.1) : n])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        same = np.mean(M.sketch(a, 160 * 8) == M.sketch(b, 160 * 8))
        assert abs(same - true) < 0.06
        assert (M.sketch(a, 160) >> np.uint64(52)).max() < 320


def test_chain_is_one_component(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(9000, 9001), (None, 3), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert {got[i] for i in range(n + 1)} == {0} and got[9001] == 9000 and len(got) == n + 3


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_floor_loses_less_than_the_bands(percent):
    p, bins = percent / 100, M.BANDS * M.ROWS
    floor = M.sketch_floor(percent, bins)
    lost = sum(math.comb(bins, c) * p**c * (1 - p) ** (bins - c) for c in range(bins) if c / bins < floor)
    assert 1e-10 < lost <= 1e-8
    assert percent > 80 or lost < 0.01 * (1 - p**M.ROWS) ** M.BANDS
