"""The streaming search against the library."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from hetgraph.llm import sentencepiece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return C.Codec(PATH)


ODD = [
    "", " ", "  ", "   a", "a  b", "x" * 500, "\n\n\t a\r\n", "Héllo wörld ①😀é", "▁a ▁", "<s> </s><unk> <0x0A>", "a\x00b",
    " " * 100, "        def f(x):\n                return x", "ﬁ　漢字仮名交じり文" * 40, "the" * 400, "https://a.b/c?d=e&f=%20" * 9, "́́á",
]


def test_odd_texts(own, library):
    for t in ODD:
        assert own.encode(t).tolist() == library.encode(t), repr(t)
        assert own.decode(library.encode(t)) == library.decode(library.encode(t))


def test_random_texts(own, library):
    rng = np.random.default_rng(0)
    pieces = list(own.ids)
    for k in range(300):
        t = "".join(pieces[i] for i in rng.integers(0, len(pieces), 30)).replace(C.SPACE, " ")
        if k % 3 == 0:
            t = "".join(rng.choice(list("aeinrst  heou.,-'x\n1"), 200))
        assert own.encode(t).tolist() == library.encode(t), repr(t)


def test_commits_early(own, library, monkeypatch):
    """Without cuts the whole text is one search; pieces must still come long before its end."""
    text = C.SPACE + "theinternationalisationofcompetitivestandards" * 50
    seen = 0

    class Watched(str):
        def __getitem__(self, at):
            nonlocal seen
            seen = max(seen, at.stop if isinstance(at, slice) else at)
            return str.__getitem__(self, at)

    out = own.viterbi(Watched(text))
    next(out)
    assert seen <= 5 * own.longest
    assert own.encode(text[1:]).tolist() == library.encode(text[1:])


def test_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = C.encoded(docs, PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip


def test_odd_rows(spark, library):
    rows = [(1, None), (None, "a b"), (1, "a b"), (1, "a b")] + [(10 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(d, t, [1]) for d, t in rows], "doc_id long, text string, ids array<int>")
    got = sorted((str(r.doc_id), r.ids) for r in C.encoded(docs, PATH).collect())
    assert got == sorted((str(d), library.encode(t or "")) for d, t in rows)
    back = C.decoded(C.encoded(docs, PATH).select("doc_id", "ids"), PATH).collect()
    assert sorted(r.text for r in back) == sorted((t or "").replace(C.SPACE, " ") for _, t in rows)
    assert C.encoded(docs.limit(0), PATH).collect() == []


def test_short_and_streaming_search_agree(own):
    rng = np.random.default_rng(3)
    for _ in range(300):
        part = C.SPACE + "".join(rng.choice(list("aeinrsthoucdlmgé.,-漢"), int(rng.integers(1, 60))))
        assert list(own.viterbi(part)) == own._short_bpe(part), part
