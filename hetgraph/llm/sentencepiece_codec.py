"""Encoding and decoding with a SentencePiece model, by a streaming Viterbi search.

The best path through the pieces of a text is searched from left to right. A place keeps the one
piece that ends there on the best path up to it, so the search looks back over one window of the longest piece's length.
As soon as the backpointers of all places in the window lead to one boundary, the ids before it
are final and given out: memory does not grow with the text.

For a unigram model the best path has the largest sum of scores. A BPE model's scores are ranks of
merges and are not to be added up. There a path is allowed if every two neighbouring pieces would
stay apart if merged alone, which exactly one path through each prefix fulfils, and that is the one which
merging gives. The test of two pieces needs at most two pieces' length of text and is remembered.
Ranks that several pieces share (runs of spaces) break that rule: strings with such pieces are merged.

Texts are cut where no piece can cross: before a space and around characters that no longer
piece holds. What lies between is short and repeats, so its ids are remembered too, up to a bound.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, list_array, process_store

SPACE = "▁"
#: Remembered strings (twice as many at most) and pairs of pieces per worker process, and the longest
#: string that is remembered.
REMEMBERED, PAIRS, LONGEST = 500_000, 800_000, 48
BPE, UNIGRAM = 2, 1
#: In place of ids: a character that is no piece, and nothing before.
UNKNOWN, NONE = -2, -1


class Codec:
    """One model: identity normalisation, a space put before the text, bytes for unknown characters."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models with identity normalisation and a dummy prefix")
        self.kind = model.trainer_spec.model_type
        if self.kind not in (BPE, UNIGRAM):
            raise ValueError("only BPE and unigram models")
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type in (1, 4)]
        self.ids = {piece: i for i, piece, _ in normal}
        self.names = [p.piece for p in model.pieces]
        self.score = {piece: s for _, piece, s in normal}
        self.longest = max(len(p) for p in self.ids)
        self.floor = min(self.score.values()) - 10
        bytes_ = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_ids = [bytes_.get(b, model.trainer_spec.unk_id) for b in range(256)]
        self.pieces = [p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        for i, p in enumerate(model.pieces):
            if p.type in (2, 3):
                self.pieces[i] = b"" if p.type == 3 else b" \xe2\x81\x87 "
        for b, i in bytes_.items():
            self.pieces[i] = bytes([b])
        shared = Counter(s for _, p, s in normal if len(p) > 1)
        tied = {p for p, s in self.score.items() if len(p) > 1 and shared[s] > 1}
        self.tied = re.compile("|".join(map(re.escape, sorted(tied)))) if tied else None
        inside = "".join(p for p in self.ids if len(p) > 1)
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        crossed = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.cut = re.compile(
            f"(?s:.+)" if crossed else f"{SPACE}+[^{SPACE}{alone}]*|[{alone}]|[^{SPACE}{alone}]+" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        )
        # Pieces that merging gives at all; a model may hold some that it never gives.
        self.reached = {
            p: i for p, i in self.ids.items() if self.kind != BPE or len(p) == 1 or self.merged_short(p) == [p]
        }
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: the best pair first, the leftmost of equals."""
        sym: list[str | None] = list(text)
        left, right = list(range(-1, len(sym) - 1)), list(range(1, len(sym) + 1))
        score, queue = self.score, []

        def push(i, j):
            if i >= 0 and j < len(sym):
                both = sym[i] + sym[j]
                if (s := score.get(both)) is not None:
                    queue.append((-s, i, j, both)) if start else heapq.heappush(queue, (-s, i, j, both))

        start = True
        for i in range(len(sym) - 1):
            push(i, i + 1)
        start = False
        heapq.heapify(queue)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if sym[i] is None or j >= len(sym) or sym[j] is None or right[i] != j or sym[i] + sym[j] != both:
                continue
            sym[i], sym[j] = both, None
            right[i] = right[j]
            if right[j] < len(sym):
                left[right[j]] = i
            push(left[i], i)
            push(i, right[i])
        return [s for s in sym if s is not None]

    def merged_short(self, text: str) -> list[str]:
        """The same for a short text, by looking through all pairs."""
        score, none = self.score, self.floor
        sym = list(text)
        pairs = [score.get(a + b, none) for a, b in zip(sym, sym[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            sym[i : i + 2] = [sym[i] + sym[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score.get(sym[i - 1] + sym[i], none)
            if i < len(pairs):
                pairs[i] = score.get(sym[i] + sym[i + 1], none)
        return sym

    def stay_apart(self, a: int, b: int, x: str, y: str) -> bool:
        """Whether merging leaves the pieces ``x`` and ``y``, with these ids, as they are."""
        found = self.merged_short(x + y) == [x, y]
        if a >= 0 and b >= 0:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            self.apart[a << 32 | b] = found
        return found

    def _last_bpe(self, text: str, low: int, end: int, done: int, starts: list, last: list) -> tuple[int, int, float] | None:
        """The one piece that may end at ``end``: where it starts, its id."""
        get, known = self.reached.get, self.apart.get
        for start in range(low, end):
            i = get(text[start:end])
            if i is None:
                if end - start > 1:
                    continue
                i = UNKNOWN
            before = last[start - done]
            if before is None:
                continue
            if before == NONE:
                return start, i, 0.0
            apart = known(before << 32 | i) if i >= 0 and before >= 0 else None
            if apart is None:
                x = self.names[before] if before >= 0 else text[start - 1 : start]
                apart = self.stay_apart(before, i, x, text[start:end])
            if apart:
                return start, i, 0.0
        return None

    def _short_bpe(self, text: str) -> list[int | str]:
        """The same path for a text that fits into the window, asked from its end: only the places
        that the answer needs are looked at."""
        get, known, low_of, marks = self.reached.get, self.apart.get, self.longest, {0: (0, NONE)}

        def last(end: int):
            if (found := marks.get(end)) is not None:
                return found
            for start in range(end - low_of if end > low_of else 0, end):
                i = get(text[start:end])
                if i is None:
                    if end - start > 1:
                        continue
                    i = UNKNOWN
                before = last(start)[1]
                if before == NONE:
                    break
                if before is None:
                    continue
                apart = known(before << 32 | i) if i >= 0 and before >= 0 else None
                if apart is None:
                    x = self.names[before] if before >= 0 else text[start - 1 : start]
                    apart = self.stay_apart(before, i, x, text[start:end])
                if apart:
                    break
            else:
                start, i = -1, None
            marks[end] = start, i
            return start, i

        path, end = [], len(text)
        while end:
            start, i = last(end)
            path.append(i if i >= 0 else text[end - 1])
            end = start
        return path[::-1]

    def _last_unigram(self, text: str, low: int, end: int, done: int, starts: list, last: list) -> tuple[int, int, float] | None:
        """The piece on the path with the largest sum of scores up to ``end``."""
        best = None
        for start in range(low, end):
            piece = text[start:end]
            i = self.ids.get(piece, UNKNOWN)
            if i == UNKNOWN and end - start > 1 or last[start - done] is None:
                continue
            total = starts[start - done][1] + self.score.get(piece, self.floor)
            if best is None or total > best[2]:
                best = (start, i, total)
        return best

    def viterbi(self, text: str) -> Iterator[int | str]:
        """Ids of ``text``, or characters that are no piece, given out as soon as they are final."""
        # For each place from ``done`` on: where its last piece starts and the score, and that piece's id.
        starts: list = [(0, 0.0)]
        last: list = [NONE]
        done, longest = 0, self.longest
        step = self._last_bpe if self.kind == BPE else self._last_unigram
        for end in range(1, len(text) + 1):
            found = step(text, max(done, end - longest), end, done, starts, last)
            if found is None:
                starts.append(None)
                last.append(None)
            else:
                starts.append((found[0], found[2]))
                last.append(found[1])
            if end - done >= 4 * longest:
                # Walk the window's places back until they are one.
                front = {p for p in range(end - longest + 1, end + 1) if last[p - done] is not None}
                while len(front) > 1:
                    place = max(front)
                    front.remove(place)
                    front.add(starts[place - done][0])
                meet = front.pop()
                if meet > done:
                    yield from self._path(text, starts, last, done, meet)
                    # The piece before the boundary is still needed to judge the next one.
                    starts, last, done = starts[meet - done :], last[meet - done :], meet
        yield from self._path(text, starts, last, done, len(text))

    @staticmethod
    def _path(text: str, starts: list, last: list, done: int, end: int):
        path = []
        while end > done:
            i = last[end - done]
            path.append(i if i >= 0 else text[end - 1])
            end = starts[end - done][0]
        return reversed(path)

    def _encode(self, part: str) -> bytes:
        if self.kind == BPE and (whole := self.reached.get(part)) is not None:
            pieces = [whole]  # the search would end with this one piece
        elif self.tied and self.kind == BPE and self.tied.search(part):
            pieces = [self.ids.get(p, p) for p in self.merged(part)]
        elif self.kind == BPE and len(part) <= 4 * self.longest:
            pieces = self._short_bpe(part)
        else:
            pieces = self.viterbi(part)
        out: list[int] = []
        for p in pieces:
            if isinstance(p, int):
                out.append(p)
            else:
                out.extend(self.byte_ids[b] for b in p.encode())
        return array("i", out).tobytes()

    def _lookup(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = self.older.get(part) or self._encode(part)
            if len(part) <= LONGEST:
                # Two generations: what is met again moves to the young one.
                if len(self.known) > REMEMBERED:
                    self.older, self.known = self.known, {}
                self.known[part] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        parts = self.cut.findall(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(map(self._lookup, parts)), np.int32)

    def decode(self, ids) -> str:
        text = b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def codec(path: str) -> Codec:
    store = process_store("sentencepiece")
    if path not in store:
        store[path] = Codec(path)
    return store[path]


def _run(path: str):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        model = codec(path)
        for b in batches:
            for at in range(0, len(b["text"]), 500):
                texts = b["text"][at : at + 500].to_pylist()
                ids = [model.encode(t) for t in texts]
                same = [model.decode(i.tolist()) == t.replace(SPACE, " ") for i, t in zip(ids, texts)]
                yield {
                    "doc_id": b["doc_id"][at : at + 500], "ids": list_array(ids, "int32"),
                    "n_ids": [len(i) for i in ids], "round_trip": pa.array(same),
                }

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, n_ids, round_trip)`` for every row of ``docs (doc_id, text, ...)``, whole texts.

    ``path`` names the model, a file on every executor. ``round_trip`` says that decoding gives the
    text back (with a space for each U+2581, which the model writes for spaces). A null text is an empty
    one and has no ids. Null ids and repeated rows are rows like all others; other columns are ignored.
    """
    return arrow_map(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        _run(path),
        "doc_id long, ids array<int>, n_ids long, round_trip boolean",
    )


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``rows (doc_id, ids)``; null ids give a null text."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        model = codec(path)
        for b in batches:
            yield {"doc_id": b["doc_id"], "text": [None if i is None else model.decode(i) for i in b["ids"].to_pylist()]}

    return arrow_map(rows.select("doc_id", "ids"), run, "doc_id long, text string")
