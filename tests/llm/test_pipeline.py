"""The pipeline against brute force, stage by stage, and on odd tables."""

from types import SimpleNamespace

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from test_minhash import brute as duplicates
from test_mixing import brute as mix

import corpus_pipeline as P
from hetgraph.llm import rules

SF = "/root/testdata/sf0.001"


def test_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in rules.judge(docs).where("kept").select("doc_id").collect()}
    rows = [r for r in docs.collect() if r.doc_id in kept]
    single = {d for d, _, _, keep in duplicates([(r.doc_id, r.text) for r in rows], 5, 80) if keep}
    rows = [SimpleNamespace(doc_id=r.doc_id, text=r.text, source=r.source) for r in rows if r.doc_id in single]

    counts = {}
    for r in rows:
        b = r.text.encode()
        for i in range(len(b) - 199):
            counts[b[i : i + 200]] = counts.get(b[i : i + 200], 0) + 1
    for r in rows:
        b = r.text.encode()
        gone = set()
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                gone.update(range(i, i + 200))
        r.text = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    taken = {d: (n, t) for d, n, _, _, t in mix([(r.doc_id, r.text, r.source) for r in rows])}
    want = []
    for r in rows:
        size, words = taken[r.doc_id]
        if size:
            want += [(r.doc_id, library.encode(r.text))] * (words // size)
    got = [(r.doc_id, r.ids) for r in P.run(spark, SF).collect() if r.n_ids]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, h string, node long"
    words = " ".join(f"w{i} the of and" for i in range(40))
    rows = [(1, words, "en", "a", 0, "k", 1, "h", 2), (2, words, "en", None, 0, "k", 1, "h", 2), (None, None, None, None, None, None, None, None, None)]
    rows += [(3, words + " more", None, "a", 3, "k", 1, "h", 2), (4, "", "en", "b", 3, "k", 1, "h", 2), (None, words, "en", "b", 3, "k", 1, "h", 2)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        d = table
        for name, stage in P.STAGES[:-1]:
            alone = stage(spark, table, SF)
            assert alone.columns == docs.columns and dict(alone.dtypes) == dict(docs.dtypes), name
            alone.collect()
            d = spark.createDataFrame(stage(spark, d, SF).collect(), schema)
        P.STAGES[-1][1](spark, d, SF).collect()


def test_mixture_of_as_many_words_as_6_gb_hold(spark, monkeypatch):
    """Each word counts as many, so that the sum lies between a third of 2^31 and 2^31."""
    rows = [(i, "w " * (i % 5 + 1), "en", f"s{i % 2}", 9) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(map(tuple, P.mixture(spark, docs, SF).collect()))
    own = P.mixing.sized
    monkeypatch.setattr(P.mixing, "sized", lambda d: own(d).withColumn("size", F.col("size") * 10_000_000))
    assert sorted(map(tuple, P.mixture(spark, docs, SF).collect())) == want
