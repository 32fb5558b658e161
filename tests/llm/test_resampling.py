"""Importance resampling against brute force."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from hetgraph.llm import resampling as R

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest)[1])
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows, able = [], []
    for d, x in docs:
        n, f = features(x, longest)
        weight = sum(gain(bucket(y)) for y in f)
        h = int(sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(f), weight, score, None])
        if n >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def rows(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 5
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_whole_table(spark, longest):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest)
    assert rows(R.resample(docs, target, longest=longest)) == want


def test_odd_rows(spark):
    words = [f"w{i}" for i in range(30)]
    texts = [None, "", " \n", "A-b_C9ÉÀ z\x00y", "x" * 3_000_000, "ab " * 300_000, " ".join(words)]
    data = list(enumerate(texts)) + [(50, " ".join(words))] * 40 + [(None, " ".join(words))] * 40
    data += [(60, " ".join(words[:25])), (60, " ".join(words[5:])), (61, "ñandú " * 20), (62, "w1 " * 19)]
    docs = spark.createDataFrame(
        [(d, t, 1, "x") for d, t in data], "doc_id long, text string, rank int, weight string"
    )
    target = spark.createDataFrame([("w1 w2 ñandú",), (None,), ("",)], "text string")
    assert rows(R.resample(docs, target, percent=50)) == brute(data, ["w1 w2 ñandú"], percent=50)
    assert rows(R.resample(docs, target.limit(0), percent=100)) == brute(data, [], percent=100)
    assert R.resample(docs.limit(0), target).collect() == []


def test_bytes_give_the_pattern_s_words():
    text = "".join(map(chr, range(0x250))) + " Ünï 42x-y"
    assert [w.decode() for w in R.words_of(text.encode())] == WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    chained = R.ngrams([b"a", b"bc", b"d", b"a"], 3)
    assert chained == Counter(zlib.crc32(g) for g in (b"a", b"bc", b"d", b"a", b"a bc", b"bc d", b"d a", b"a bc d", b"bc d a"))
