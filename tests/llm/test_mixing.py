"""The mix against its definition."""

import collections
import hashlib
import re

from hetgraph.llm import mixing

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Targets by repeated sharing, choice by a walk along the sorted hashes."""
    docs = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    size = collections.Counter()
    for _, s, n in docs:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        rest, shares = total - sum(3 * size[s] for s in capped), sum(w[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and w[s] * rest > 3 * size[s] * shares}
        if not more:
            break
        capped |= more
    out = []
    for s in order:
        num, den = (3 * size[s], 1) if s in capped else (w[s] * rest, shares)
        copies = num // (den * size[s]) if size[s] else 0
        left = (num - copies * den * size[s]) // den
        hashed = collections.defaultdict(list)
        for d, n in ((d, n) for d, x, n in docs if x == s):
            hashed[int(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()[:15], 16)].append((d, n))
        below = 0
        for h in sorted(hashed):
            m = sum(n for _, n in hashed[h])
            taken = below + m <= left or (below <= left and below + m - left < left - below)
            below += m
            out += [(d, n, size[s], num / den, n * (copies + taken)) for d, n in hashed[h]]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(mixing.mix(docs))
    assert got == brute([(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 4}") for i in range(200)] + [(500 + i, "w " * 900, "s1") for i in range(40)]
    rows += [(900, None, "s1"), (901, "", "empty"), (902, "one", None), (902, "one", None), (None, "a b", None), (903, "x " * 5000, "")]
    docs = spark.createDataFrame([(*r, 7, 1) for r in rows], "doc_id long, text string, source string, h int, copies int")
    got = rows_of(mixing.mix(docs))
    assert got == brute(rows)
    assert mixing.mix(docs.limit(0)).collect() == []
    assert rows_of(mixing.mix(docs.where("source = 'empty'"))) == [(901, 0, 0, 0.0, 0)]
    out = mixing.mixed(docs)
    assert out.schema == docs.schema
    taken = sum(len((r.text or "").split()) for r in out.collect())
    assert taken == sum(r[4] for r in got)


def test_smaller_budgets_are_nested(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("source = 'src1'")
    sizes = mixing.sized(docs).cache()
    taken = []
    for rest in (500, 3000, 9000):
        cut = mixing.thresholds(sizes, sizes.select(*mixing.KEY).distinct().selectExpr("*", f"{rest}L AS rest")).first()
        chosen = {r.doc_id for r in sizes.collect() if r.h < cut.cut or (r.h == cut.cut and cut.with_cut)}
        taken.append(chosen)
        assert abs(sum(r["size"] for r in sizes.collect() if r.doc_id in chosen) - rest) < 1500
    assert taken[0] <= taken[1] <= taken[2]


def test_targets_of_large_sources(spark):
    """Sums of words under and over 32 bits, and a source that lacks little of its second copy."""
    for sizes in ([60_000_000 + i for i in range(20)], [999_999_999, 400_000_000, 1_000_000_000], [10**15] * 40):
        rows = [(False, f"s{i:02d}", n) for i, n in enumerate(sizes)]
        w = [i % 3 + 1 for i in range(len(sizes))]
        total, shares = sum(sizes), sum(w)
        assert all(a * total <= 3 * n * shares for a, n in zip(w, sizes))
        got = mixing.targets(spark.createDataFrame(rows, "no_source boolean, source string, size long")).orderBy("source").collect()
        copies = [a * total // (n * shares) for a, n in zip(w, sizes)]
        assert [r.copies for r in got] == copies
        assert [r.rest for r in got] == [(a * total - c * n * shares) // shares for a, n, c in zip(w, sizes, copies)]
        assert [r.target for r in got] == [float(a * total) / shares for a in w]
