"""Vector codes against plain Lloyd."""

import math
from hashlib import sha256

import numpy as np
import pytest

from hetgraph.llm import product_codes as P

SCHEMA = "vec_id long, embedding array<double>, label int, code string, ids long"


def brute(rows, parts=4, entries=256, rounds=4):
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) and abs(x) < 2**14 for x in r[1])]
    lengths = [len(r[1]) for r in rows]
    if not rows:
        return []
    d = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    rows = [r for r in rows if len(r[1]) == d]
    x = np.array([[math.floor(1024 * v) for v in r[1]] for r in rows], dtype=object)
    firsts = {}
    for r in rows:
        firsts[r[0]] = min(firsts.get(r[0], r[1]), r[1])
    order = sorted(firsts, key=lambda i: (i is None, i or 0))[:entries]
    start = np.array([[math.floor(1024 * v) for v in firsts[i]] for i in order], dtype=object)
    code, error, text = [""] * len(rows), np.zeros(len(rows), dtype=object), []
    for p in range(parts):
        a, b = p * d // parts, (p + 1) * d // parts
        y, c = x[:, a:b], start[:, a:b].copy()
        for turn in range(rounds + 1):
            dist = [[int(((v - e) ** 2).sum()) for e in c] for v in y]
            near = [min(range(len(c)), key=lambda e: (q[e], e)) for q in dist]
            if turn < rounds:
                for e in set(near):
                    mine = y[[i for i, n in enumerate(near) if n == e]]
                    c[e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
        for i, n in enumerate(near):
            code[i] += f"{n:02x}"
            error[i] += dist[i][n]
        text += [str(int(v)) for e in c for v in e]
    digest = sha256(",".join(text).encode()).hexdigest()
    by = {}
    for r, e in zip(rows, error):
        by[r[2]] = by.get(r[2], 0) + e
    return sorted(((r[0], code[i], int(error[i]), int(by[r[2]]), digest) for i, r in enumerate(rows)), key=str)


def of(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out, _ = P.compress(table, **options)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label")
    want = brute([(r.vec_id, r.embedding, r.label) for r in table.collect()], entries=64)
    out, books = P.compress(table, entries=64)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert [b.shape for b in books] == [(64, 16)] * 4


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i * 3, rng.normal(size=8).round(3).tolist(), [None, 1, 2][i % 3]) for i in range(120)]
    rows += [(1000 + i, rows[0][1], 5) for i in range(400)]  # one very common vector
    rows += [(9, rows[7][1], 1), (9, rows[8][1], 1), (None, [0.5] * 8, None), (None, [-0.5] * 8, 1)]
    rows += [(70, None, 1), (71, [], 1), (72, [1.0] * 7, 1), (73, [None] + [1.0] * 7, 1), (74, [math.nan] * 8, 1)]
    rows += [(75, [math.inf] + [0.0] * 7, 1), (76, [1e30] + [0.0] * 7, 1), (77, [16383.0] * 8, 3), (78, [-16383.9] * 8, 3)]
    assert of(spark, rows, entries=20) == brute(rows, entries=20)
    few = rows[:5] + [(None, [0.25] * 8, 1)]
    assert of(spark, few) == brute(few)
    assert of(spark, [(1, [1.0, 2.0], 1), (2, [3.0], 1)]) == brute([(1, [1.0, 2.0], 1), (2, [3.0], 1)])
    assert of(spark, [(1, None, 1)]) == [] and of(spark, []) == []


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "line"])
def test_walk_decides_as_comparison_does(kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)) * 200
    if kind == "clusters":
        middle = rng.normal(size=(20, 16)) * 400
        x = middle[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 16)) * 5
    if kind == "copies":
        x[500:2500] = x[0]
    if kind == "line":
        x[:, 1:] = 0
    x = x.astype(np.int64)
    book = np.concatenate([x[:100], x[:20], x[50:90] + 1])  # ties between entries
    if kind == "clusters":
        book = np.concatenate([middle, middle[5:]]).astype(np.int64)
    tree, order = P.grow(x)
    assert sorted(order) == list(range(3000))
    y = x[order]
    for n in range(len(tree.start)):
        mine = y[tree.start[n] : tree.end[n]]
        assert ((mine - y[tree.centre[n]]) ** 2).sum(axis=1).max() <= tree.radius[n] ** 2 * (1 + 1e-12)
    start, end, entry, rows, single = P.walk(tree, y, book)
    found = np.full(3000, -1)
    found[P._ranges(start, end)] = np.repeat(entry, end - start)
    assert (found[rows] == -1).all()
    found[rows] = single
    want = ((y[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (found == want).all()
    total, n = P._sums(tree, y, book)
    assert (n == np.bincount(want, minlength=len(book))).all()
    assert all((total[e] == y[want == e].sum(axis=0)).all() for e in range(len(book)))
    if kind in ("clusters", "copies"):
        assert len(rows) < 1500  # most rows are assigned with their node
