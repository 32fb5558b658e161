"""SimHash against brute force."""

import re

import numpy as np
import pytest
import xxhash

from hetgraph.llm import simhash as S

SF = "/root/testdata/sf0.01"
COLUMNS = "doc_id long, text string, print long, component_id string, fingerprint int"


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64(" ".join(w[i : i + k]).encode(), seed=42).intdigest() for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_names(prints, bits=2):
    """The smallest place that each place reaches."""
    x = np.array(prints, np.uint64)
    name = list(range(len(x)))

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[:i] ^ x[i]) <= bits):
            a, b = find(i), find(int(j))
            name[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    of = {}
    names = brute_names(prints)
    for (d, _), n in zip(rows, names):
        of.setdefault(n, []).append(d)
    first = {n: min((d for d in ds if d is not None), default=None) for n, ds in of.items()}
    return sorted(((d, f"{p:016x}", first[n]) for (d, _), p, n in zip(rows, prints, names)), key=str)


def got(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(S.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 300, 400)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  two\n"), (8, "É x"), (9, "é x")]
    for i in range(60):  # near copies
        w = list(base)
        w[int(rng.integers(0, 400))] = f"n{i}"
        rows.append((100 + i, " ".join(w)))
    rows += [(300 - i, " ".join(base)) for i in range(40)] + [(None, " ".join(base))] * 3 + [(None, "alone")] * 2
    rows += [(7, "another text"), (7, "another text"), (400, "ab " * 400_000), (401, "y" * 2_000_000)]
    docs = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], COLUMNS)
    assert got(S.near_duplicates(docs)) == brute(rows)
    assert got(S.near_duplicates(docs.limit(0))) == []
    assert got(S.near_duplicates(docs.where("doc_id = 4"))) == brute(rows[3:4])


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_no_near_pair_is_missed(spark, bits, monkeypatch):
    """Chains, stars and a crowded list, which is dealt anew, against all pairs."""
    monkeypatch.setattr(S, "LIST", 150)
    rng = np.random.default_rng(bits)
    x = list(rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2))
    for i in range(400):
        y = x[int(rng.integers(0, len(x)))]
        for b in rng.choice(64, int(rng.integers(1, bits + 3)), replace=False):
            y ^= np.uint64(1 << int(b))
        x.append(y)
    x += [np.uint64(0xABCDEF0000000000 | int(v)) for v in rng.choice(2**14, 900, replace=False)]
    x = sorted(set(map(int, x)))
    signed = [(v - 2**64 if v >> 63 else v,) for v in x]
    found = S.links(spark.createDataFrame(signed, "print long"), bits).collect()
    name = {v: i for i, v in enumerate(x)}
    a, b = (np.array([name[r[c] % 2**64] for r in found], np.int64) for c in ("a", "b"))
    assert (np.bitwise_count(np.array(x, np.uint64)[a] ^ np.array(x, np.uint64)[b]) <= 64).all()
    assert S._forest(len(x), a, b).tolist() == brute_names(x, bits)


def test_forms_of_a_list_agree():
    rng = np.random.default_rng(7)
    x = np.unique(rng.integers(0, 2**12, 700).astype(np.uint64) | np.uint64(0x7700000000000000))
    pairs = [set(zip(*map(np.ndarray.tolist, f(x, 2)))) for f in (S.tallied, S.looked_up)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 1000


def test_choices_of_positions():
    for bits, n in ((1, 4), (2, 6), (3, 4)):
        assert len(S.entries(bits)) == n
    assert len(S.choices(2)) == 28
