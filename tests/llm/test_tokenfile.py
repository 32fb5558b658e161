"""Token files: exact round trips, reading of single documents, damage."""

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from hetgraph.llm import tokenfile as T

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
ODD = [
    None, "", " \n ", "Hello World's don't", "<|endoftext|> x<|startoftext|>y", "a　b\x85c\x1cd\te", "É é é ﬁ ①²Ⅷ İI",
    "x" * 300, "don 't\n's", "漢字かな交じり文 123abc 😀😀", "á ́b", "ΣΑΣ ΣΑΣ.",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def want(tokenizer, rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_words_are_exact(tokenizer):
    own = T.Tokens(PATH)
    rng = np.random.default_rng(0)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(list("aB's tdé\n\t.,1́　ΣσİI<|>"), 60)) for _ in range(500)]
    texts += [" ".join(f"{a}{b}{c}" for a in ("Word", "don't", "É", "x1", "'s", "") for b in ("", ",", "'", "...", "!?'s", "###", "|>", "<|")) for c in ("", "a")]
    for t, ids in zip(texts, own(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_the_older_memory_is_looked_up_not_walked(tokenizer):
    class Held(dict):
        def __iter__(self):
            raise AssertionError("all remembered strings were walked for one batch")

    own = T.Tokens(PATH)
    first, second = "an older Word, kept...", "Word, once more older Than kept... before"
    own([first])
    own.older, own.young = Held(own.young), {"": b""}
    got = own([second, "", "  "])
    assert np.frombuffer(got[0], "<u4").tolist() == tokenizer.encode(second, add_special_tokens=False).ids
    assert got[1:] == [b"", b""] and "older" in own.young and "an" not in own.young


def test_case_and_signs_make_no_strings_of_their_own(tokenizer):
    own = T.Tokens(PATH)
    text = " ".join(f"{w}{s}" for w in ("word", "Word", "WORD", "\xe9t\xe9", "\xe0\xdf", "end\n") for s in ("", ",", ".", "!?'s", "###", "|>"))
    assert np.frombuffer(own([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert set(own.young) == {"", "word", "\xe9t\xe9", "\xe0\xdf", "end", ",", ".", "!?'s", "###", "|>"}


def test_runs_of_a_column_are_exact(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "RUN_BYTES", 256)
    rng = np.random.default_rng(1)
    texts = ["", "H\u0331, h\u0331 T\u0308.", "<|ENDOFTEXT|> <|endoftext|>,x", "", "=\u0338 A,\u0338b", "I\u0307'S \u0130, \xc9\u0323!"]
    texts += ["".join(rng.choice(list("aHI\xc9\xe9\xdf\xaa\u03a3\u212a  ,.'s<|=\n1" + "\u0331\u0307" * (i % 2)), 40)) for i in range(300)]
    column, own, got = pa.array(["first", *texts, ""])[1:], T.Tokens(PATH), []
    for run in T._runs(column):
        got += own(column[run])
    assert len(got) == len(column) and len([*T._runs(column)]) > 20
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(T.token_digests(docs, PATH)) == want(tokenizer, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, tokenizer, tmp_path):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "n"), (3, "again"), (3, "again"), (9, "w " * 40_000)]
    docs = spark.createDataFrame([(d, t, 5, "f") for d, t in rows], "doc_id long, text string, part int, file string")
    assert rows_of(T.token_digests(docs, PATH)) == want(tokenizer, rows)
    assert T.token_digests(docs.limit(0), PATH).collect() == []
    folder = str(tmp_path / "some")
    index = T.write_tokens(docs, PATH, folder, frame_bytes=64)
    one = T.read_tokens(index.where("doc_id = 9"), folder).orderBy("n_tokens").collect()
    assert [r.n_tokens for r in one] == [len(tokenizer.encode(ODD[3]).ids) + 1, 40_001]


def test_format(tmp_path):
    raw = io.BytesIO()
    writer = T.Writer(raw, 100)
    docs = [np.arange(n, dtype="<u4").tobytes() for n in (3, 0, 40, 1, 1, 500, 2)]
    places = [writer.add(d) for d in docs]
    writer.close()
    data = raw.getvalue()
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as r:
        assert r.read() == b"".join(docs)
    reader = T.Reader(pa.PythonFile(io.BytesIO(data), "r"))
    for d, (frame, offset) in zip(docs, places):
        if d:
            assert reader.frame(frame)[offset : offset + len(d)] == d
    broken = bytearray(data)
    broken[reader.starts[2] + reader.table[2][0] - 1] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        T.Reader(pa.PythonFile(io.BytesIO(bytes(broken)), "r")).frame(2)


def test_files_of_repeated_tasks_go(tmp_path):
    """Only files of the same job that the index does not name are deleted."""
    for name in ("part-a-1.zst", "part-a-2.zst", ".part-a-3.zst.tmp", "part-b-1.zst"):
        (tmp_path / name).write_bytes(b"x")
    T._delete_unnamed(str(tmp_path), "part-a", {"part-a-2.zst"})
    assert sorted(p.name for p in tmp_path.iterdir()) == ["part-a-2.zst", "part-b-1.zst"]
    T._delete_unnamed(str(tmp_path / "none"), "part-a", set())
