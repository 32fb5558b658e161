"""The classifier: gradients, held-out accuracy, odd rows."""

import zlib

import numpy as np

from hetgraph.llm import quality_mil as Q

SF = "/root/testdata/sf0.1"


def test_gradients():
    rng = np.random.default_rng(0)
    x, bags, y = rng.normal(size=(9, 256 + Q.MEASURES)).astype(np.float32), np.array([3, 0, 1, 5]), np.array([1, 0, 0, 1.0])
    model = Q.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    loss = lambda: -np.mean(np.log(np.where(y == 1, (s := model.forward(x, bags)[0]), 1 - s)))
    for k, g in model.gradients(x, bags, y).items():
        flat = model.p[k].reshape(-1)
        for i in rng.integers(0, len(flat), 5):
            keep = flat[i]
            flat[i] = keep + 1e-4
            up = loss()
            flat[i] = keep - 1e-4
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-4 - g.reshape(-1)[i]) < 2e-3, k


def test_passages():
    texts = [b"", b" \n", b"a b a", b"x " * 130, "ü é".encode()]
    x, bags = Q.encode_passages(texts)
    assert bags.tolist() == [0, 0, 1, 3, 1] and x.shape == (5, 256 + Q.MEASURES)
    alone = np.concatenate([Q.encode_passages([t])[0] for t in texts])
    assert np.allclose(x, alone)
    assert np.isclose(x[0, 256], 2 / 3) and np.isclose(x[1, 256], 1 / 64)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.score(docs, Q.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    fresh = [r for r in got if r.held_out]
    good = [r.predicted for r in fresh if r.quality == 1]
    bad = [r.predicted for r in fresh if r.quality == 0]
    assert len(fresh) > 500 and np.mean(good) > 0.97 and np.mean(bad) < 0.05


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "text"), (4, "a"), (4, "a"), (5, "long words " * 200_000)]
    docs = spark.createDataFrame([(d, t, 1, 0.5) for d, t in rows], "doc_id long, text string, quality int, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (4, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    none = docs.limit(0)
    assert Q.score(none, Q.fit(none, labels.limit(0))).collect() == []


def test_fit_keeps_to_the_sum_of_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q.Model, "fit", lambda self, x, bags, y: seen.append((int(bags.sum()), len(y))) or self)
    docs = spark.createDataFrame([(i, "w " * 64) for i in range(200)] + [(0, "longer " * 64)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    Q.fit(docs, labels)
    monkeypatch.setattr(Q, "FIT_TOTAL", 128 * 21)
    Q.fit(docs, labels)
    monkeypatch.setattr(Q, "FIT_TOTAL", 0)
    Q.fit(docs, labels)
    assert len(seen) == 2 and seen[1] == (21, 21) and seen[0][0] == seen[0][1] > 140
