"""The counts against plain Python, the estimation against planted votes."""

import collections
import re

from pyspark.sql import functions as F

from hetgraph.llm import rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rules.judge(docs).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(texts[r.doc_id])


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c"), (4, "a"), (5, "a b"), (6, "a b c a b c"), (7, "a a a a a"),
        (8, "x\ny\nx\n\nx\r\n z"), (9, "é ü 😀 #*$%&|<>"), (None, "q " * 60), (4, "a"), (10, "w　x y\n" * 400),
        (11, "the cat sat on the mat " * 4000),
    ]
    docs = spark.createDataFrame([(d, t, i, "h") for i, (d, t) in enumerate(rows)], "doc_id long, text string, n_words long, h string")
    got = rules.judge(docs).collect()
    assert sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in got) == sorted((str(d), *brute(t)) for d, t in rows)
    assert rules.judge(docs.limit(0)).collect() == []
    assert rules.keep_good(docs).schema == docs.schema


def test_junk_goes_and_clean_stays(spark):
    judged = rules.judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    r = judged.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").groupBy("quality").agg(
        F.count_if("kept").alias("kept"), F.count_if(F.expr("not kept and n_words >= 50")).alias("gone")
    )
    found = {x.quality: x for x in r.collect()}
    assert found[1].gone == 0 and found[0].kept < 0.01 * found[0].gone


def test_keep_good_is_the_judgement(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(5))
    kept = rules.judge(docs).where("kept").count()
    out = rules.keep_good(docs)
    assert out.count() == kept and out.columns == docs.columns


def test_no_python_in_the_plan(spark):
    plan = rules.judge(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    plan += rules.features(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
