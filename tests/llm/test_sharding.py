"""Shards: the law, the slots, and that linked documents meet."""

import collections
import zlib

from hetgraph.llm import sharding as S


def check(rows, got, shards):
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    counts = collections.Counter(r.shard for r in got)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert {r.law for r in got} <= {"rows"} and {r.grown_shard for r in got} <= {None}


def kept_links(got):
    """Share of linked pairs in one shard."""
    groups = collections.defaultdict(collections.Counter)
    for r in got:
        groups[r.text_crc32][r.shard] += 1
    pairs = sum(n * (n - 1) // 2 for g in groups.values() for n in [sum(g.values())])
    return sum(n * (n - 1) // 2 for g in groups.values() for n in g.values()) / max(pairs, 1)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = S.sharded(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got, 24)
    assert kept_links(got) > 0.9


def test_hot_group_and_odd_rows(spark):
    rows = [(i, f"t{i}") for i in range(600)] + [(1000 + i, "hot") for i in range(400)] + [(2000 + i, f"g{i % 40}") for i in range(160)]
    rows += [(None, None), (None, ""), (5, "t5"), (5, "t5"), (7, "ü" * 9_000)]
    docs = spark.createDataFrame([(d, t, 1, "g") for d, t in rows], "doc_id long, text string, shard int, grp string")
    got = S.sharded(docs, shards=8).collect()
    check(rows, got, 8)
    small = [r for r in got if r.text_crc32 != zlib.crc32(b"hot")]
    assert kept_links(small) > 0.7
    assert S.sharded(docs.limit(0)).collect() == []
    few = docs.limit(5)
    check([(r.doc_id, r.text) for r in few.collect()], S.sharded(few).collect(), 24)


def split_of(got, text):
    return sorted(collections.Counter(r.shard for r in got if r.text_crc32 == zlib.crc32(text.encode())).values())


def test_one_third_in_one_group(spark):
    hot = [(i, "hot") for i in range(4_000)]
    alone = spark.createDataFrame(hot + [(10_000 + i, f"t{i}") for i in range(8_000)], "doc_id long, text string")
    assert split_of(S.sharded(alone).collect(), "hot") == [500] * 8
    # Pairs have to leave the shards that the group fills.
    rows = hot[:3_700] + [(10_000 + i, f"t{i // 2}") for i in range(8_300)]
    got = S.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got, 24)
    assert split_of(got, "hot")[-7:] == [500] * 7 and len(split_of(got, "hot")) == 8
    assert kept_links([r for r in got if r.text_crc32 != zlib.crc32(b"hot")]) > 0.9


def test_every_row_has_a_copy(spark):
    for n, least in ((2, 0.95), (5, 0.9), (60, 0.9)):
        rows = [(i, f"t{i // n}") for i in range(12_000)]
        got = S.sharded(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        check(rows, got, 24)
        assert kept_links(got) > least


def test_flows_count_departures():
    # 0 and 1 are full: 1 can take what 0 sends once its own have gone to 2.
    got = S._flows([0, 0, 5], {(0, 1): 5, (1, 2): 5, (2, 0): 3})
    assert got == {(0, 1): 1.0, (1, 2): 1.0, (2, 0): 1.0}
