"""Suffix arrays and repeated passages against brute force."""

import collections
import hashlib

import numpy as np
import pytest

from hetgraph.llm import suffix as S
from hetgraph.llm import suffix_dedup as D

SF = "/root/testdata/sf0.01"


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        t = rng.integers(0, rng.integers(1, 5) + 1, n).astype(np.uint8)
        assert list(S.suffix_array(t, 1000)) == sorted(range(n), key=lambda i: bytes(t[i:]))
        for length in (1, 2, 3, 7):
            w = np.zeros(n, np.int64)
            w[: max(0, n - length + 1)] = rng.integers(1, 3)
            counts = collections.Counter()
            for i in range(n - length + 1):
                counts[bytes(t[i : i + length])] += w[i]
            got = S.repeated_starts(t, w, length)
            assert [bool(x) for x in got[: max(0, n - length + 1)]] == [counts[bytes(t[i : i + length])] >= 2 for i in range(n - length + 1)]


def brute(rows, length=200):
    counts = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        counts.update(hash(b[i : i + length]) for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if counts[hash(b[i : i + length])] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(D.digests(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("many", [5_000, 3])
def test_odd_rows(spark, monkeypatch, many):
    monkeypatch.setattr(D, "MANY", many)
    monkeypatch.setattr(D, "PIECE", 5_000)
    rng = np.random.default_rng(2)
    text = lambda n: "".join(rng.choice(list("abcdé ü\n"), n))
    shared, once = text(260), text(900)
    rows = [(i, text(300) + shared[: 200 + i] + text(250)) for i in range(20)]
    rows += [(100 + i, once[:450] + str(i) + once[450:]) for i in range(12)]
    rows += [(200, None), (201, ""), (202, "x" * 199), (203, "y" * 200), (204, "z" * 201), (205, "ab" * 9_000), (206, "short")]
    rows += [(207, once), (207, once), (None, once), (208, text(30_000) + shared + text(9_000)), (209, "y" * 200)]
    docs = spark.createDataFrame([(d, t, b"k", d) for d, t in rows], "doc_id long, text string, key binary, n long")
    assert rows_of(D.digests(docs)) == brute(rows)
    out = D.without_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString() and out.count() == len(rows)
    assert D.digests(docs.limit(0)).collect() == []


def test_one_text_per_group_of_copies_is_cut(spark, monkeypatch):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh "), 1_500))
    docs = spark.createDataFrame([(i, text) for i in range(400)] + [(900, "q" * 50 + text[300:900])], "doc_id long, text string")
    seen, plain = spark.sparkContext.accumulator(0), D._cut_out

    def counted(length):
        cut = plain(length)

        def run(batches):
            for b in batches:
                seen.add(len(b["text"]))
                yield from cut(iter([b]))

        return run

    monkeypatch.setattr(D, "_cut_out", counted)
    assert rows_of(D.digests(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert 1 <= seen.value <= 2
