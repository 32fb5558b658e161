"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds documents in ascending order. A frame holds the ids of some whole documents as
little-endian unsigned 32-bit integers, compressed on its own. The last frame is a skippable one in the
public seekable layout: for each frame its compressed size, its size and a checksum (the low 32 bits
of XXH64 of its content), then the number of frames, a descriptor and a magic number. A reader
takes the table from the end of the file and decompresses only the frames it needs; an ordinary
zstandard decoder reads the file as well.

One task writes one file under a temporary name and renames it. A task that is run again or twice writes another
file; the index names one of them, and what it does not name is deleted once it is written. The folder must be shared; it
is opened by its URI.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, process_store
from hetgraph.runtime import checkpoint_root, materialize

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Bytes of ids after which a frame ends, and bytes of text to a file.
FRAME_BYTES, FILE_BYTES = 1 << 18, 64 << 20
#: Strings that a worker process remembers, in each of two generations.
REMEMBERED = 200_000
#: A letter before an ASCII sign, which is neither letter nor digit nor space.
LETTER_SIGN = f"([a-zªµºÀ-ÖØ-öø-ÿ])([{re.escape(string.punctuation)}])"
#: Marks that compose with a letter before them, and what begins a special token.
MARKS = r"\pM|<\|"
#: Bytes of text whose strings are looked up together.
RUN_BYTES = 2 << 20
#: Strings of characters that composition leaves alone and that have their small letters one by one.
LATIN = re.compile("[\0-\xff]*").fullmatch
#: Strings that the tokenizer gets in one call.
TOGETHER = 2_000


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    if not urlparse(uri).scheme:
        uri = "file://" + os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


class Writer:
    """One file; ``add`` gets the ids of one document and returns its frame and its place in the frame."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.held: list[bytes] = []
        self.room, self.table = 0, []
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, ids: bytes) -> tuple[int, int]:
        if self.room and self.room + len(ids) > self.frame_bytes:
            self._flush()
        at = len(self.table), self.room
        self.held.append(ids)
        self.room += len(ids)
        return at

    def _flush(self):
        content = b"".join(self.held)
        frame = self.compressor.compress(content)
        self.out.write(frame)
        self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.held, self.room = [], 0

    def close(self):
        if self.room:
            self._flush()
        entries = b"".join(struct.pack("<III", *t) for t in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)


class Reader:
    """One file; ``frame`` decompresses one frame and checks it."""

    def __init__(self, file):
        self.file, size = file, file.size()
        file.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        file.seek(size - 9 - 12 * n)
        raw = file.read(12 * n)
        self.table = [struct.unpack_from("<III", raw, 12 * i) for i in range(n)]
        self.starts = [0, *accumulate(t[0] for t in self.table)]
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        packed, size, checksum = self.table[i]
        self.file.seek(self.starts[i])
        content = self.decompressor.decompress(self.file.read(packed), max_output_size=size)
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return content


def _parted(texts: pa.Array) -> pa.Array:
    """Lines joined by a space, small ASCII letters, and a space between a Latin letter and an ASCII sign after it.

    No token holds a letter and a sign after it. What a mark may compose with and what may be a
    special token stays as it is.
    """
    lines = pc.replace_substring(texts, "\n", " ")
    odd = pc.match_substring_regex(lines, MARKS)
    parted = pc.replace_substring_regex(pc.ascii_lower(lines), LETTER_SIGN, r"\1 \2")
    return pc.replace_with_mask(parted, odd, lines.filter(odd))


def _runs(texts: pa.Array) -> Iterator[slice]:
    """Slices of whole texts of about ``RUN_BYTES``."""
    run = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // RUN_BYTES
    starts = np.flatnonzero(np.diff(run, prepend=-1)).tolist()
    return map(slice, starts, [*starts[1:], len(texts)])


class Tokens:
    """Ids of whole texts by a tokenizer that lower-cases, drops white space and parts letters from signs.

    The different strings between spaces of some texts are looked up; what is new goes to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # A special token parts strings before anything else looks at them.
        self.mark, self.mark_id = next(
            ((t.content, i) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special), (None, -1)
        )
        # The same model for words that need no preparation; the last id of a word tells its end.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.direct = bool(suffix) and all(
            self.bare.encode(w).ids == self.tokenizer.encode(w, add_special_tokens=False).ids
            for w in ("a", "the", "unwordlike", "qzx", "\xe9t\xe9", "\xdf\xf1\xb5")
        )
        self.young: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: pa.Array | list[str]) -> list[bytes]:
        parts = pc.split_pattern(_parted(pa.array(texts, pa.large_string())), " ")
        coded = parts.flatten().dictionary_encode()
        strings = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(strings)
        ids = pa.array([*map(self.young.__getitem__, strings)], pa.large_binary()).take(coded.indices)
        # The ids of all strings follow one another in one buffer.
        starts, raw = np.frombuffer(ids.buffers()[1], np.int64), ids.buffers()[2]
        at = starts[parts.offsets.to_numpy()].tolist()
        return [raw[a:b].to_pybytes() if a < b else b"" for a, b in zip(at, at[1:])]

    def _learn(self, strings: list[str]):
        if len(self.young) > REMEMBERED:
            self.older, self.young = self.young, {"": b""}
        young, older, new = self.young, self.older, []
        for p in strings:
            if p not in young:
                ids = older.get(p)
                if ids is None:
                    new.append(p)
                else:
                    young[p] = ids
        self._encode(new)

    def _encode(self, new: list[str]):
        # A word of Latin letters comes to the model in small ones: no need to prepare it otherwise.
        plain = [p for p in new if p.isalpha() and (p.isascii() or LATIN(p))] if self.direct else []
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some).lower()], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            raw = ids.tobytes()
            self.young.update(zip(some, (raw[a:b] for a, b in zip([0, *ends], ends)), strict=True))
        if plain:
            new = [p for p in new if p not in self.young]
        alone = [p for p in new if self.mark is None or self.mark in p]
        for p, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.young[p] = np.array(e.ids, "<u4").tobytes()
        rest = [p for p in new if p not in self.young] if alone else new
        for at in range(0, len(rest), TOGETHER):
            some = rest[at : at + TOGETHER]
            found = self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids
            ids = np.array(found, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)).tolist()
            raw, start = ids.tobytes(), 0
            for p, end in zip(some, ends):
                self.young[p] = raw[4 * start : 4 * end]
                start = end + 1


def _tokens(path: str) -> Tokens:
    store = process_store("tokenizers")
    if path not in store:
        store[path] = Tokens(path)
    return store[path]


def _write(path: str, folder: str, end_id: int, frame_bytes: int, job: str):
    """Encode the rows of a sorted partition into one file; a row per document, and its place."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encode, system, writer, out = None, None, None, None
        name = f"{job}-{uuid.uuid4().hex}.zst"
        for b in batches:
            if writer is None:
                system, root = opened(folder)
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/.{name}.tmp", compression=None)
                encode, writer = _tokens(path), Writer(out, frame_bytes)
            for run in _runs(b["text"]):
                ids = [i + end for i in encode(b["text"][run])]
                places = [writer.add(i) for i in ids]
                yield {
                    "doc_id": b["doc_id"][run], "part": b["part"][run], "file": [name] * len(ids),
                    "frame": [p[0] for p in places], "offset": [p[1] for p in places], "n_tokens": [len(i) // 4 for i in ids],
                }
        if writer is not None:
            writer.close()
            out.close()
            system.move(f"{root}/.{name}.tmp", f"{root}/{name}")

    return run


def _delete_unnamed(folder: str, job: str, named: set[str]):
    """Delete the files of this job that are not in its index: those of repeated tasks, and unfinished ones."""
    system, root = opened(folder)
    for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if f.base_name.lstrip(".").startswith(job) and f.base_name not in named:
            system.delete_file(f.path)


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the ids of ``docs (doc_id, text, ...)`` to ``folder`` and return the index of documents.

    ``(doc_id, start, n_tokens, file, frame, offset)``: ``start`` counts the ids of all documents before,
    in ascending order of doc_id (nulls first); equal ids come in the order of their texts. ``offset`` is in
    bytes of the frame. A null text is an empty one: it has the end id alone. Other columns are ignored;
    an empty table gives no files and no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // FILE_BYTES))
    sorted_ = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    placed = sorted_.withColumn("part", F.spark_partition_id())
    job = f"part-{uuid.uuid4().hex[:12]}"
    schema = "doc_id long, part int, file string, frame int, offset long, n_tokens long"
    index = materialize(arrow_map(placed, _write(path, folder, end_id, frame_bytes, job), schema), "token_index")
    # One number per file comes to the driver.
    sums = sorted((r["part"], r["file"], r["n"]) for r in index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")).collect())
    _delete_unnamed(folder, job, {f for _, f, _ in sums})
    before = [0, *accumulate(n for *_, n in sums)]
    starts = texts.sparkSession.createDataFrame([(f, s) for (_, f, _), s in zip(sums, before)], "file string, file_start long")
    inside = F.sum("n_tokens").over(W.partitionBy("file").orderBy("frame", "offset").rowsBetween(W.unboundedPreceding, -1))
    return index.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(starts), "file").select(
        "doc_id", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "file", "frame", "offset"
    )


def _read(folder: str):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        system, root = opened(folder)
        name, reader, at, content = None, None, None, b""
        for b in batches:
            out = []
            for file, frame, offset, n in zip(*(b[c].to_pylist() for c in ("file", "frame", "offset", "n_tokens"))):
                if file != name:
                    name, reader, at = file, Reader(system.open_input_file(f"{root}/{file}")), None
                if frame != at:
                    at, content = frame, reader.frame(frame)
                out.append(content[offset : offset + 4 * n])
            yield {"doc_id": b["doc_id"], "start": b["start"], "n_tokens": b["n_tokens"], "ids": pa.array(out, pa.binary())}

    return run


def read_tokens(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the rows of an index or of some of them; ``ids`` as stored.

    Only the frames that hold a wanted document are read and decompressed, each once per task.
    """
    wanted = index.select("doc_id", "start", "n_tokens", "file", "frame", "offset")
    grouped = wanted.repartition("file", F.expr("frame div 64")).sortWithinPartitions("file", "frame", "offset")
    return arrow_map(grouped, _read(folder), "doc_id long, start long, n_tokens long, ids binary")


def token_digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write all documents below the checkpoint folder, read the files back, and digest the ids."""
    spark = docs.sparkSession
    folder = f"{checkpoint_root(spark)}/hetgraph/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    index = write_tokens(docs, path, folder, end_id)
    return read_tokens(index, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
