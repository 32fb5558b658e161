"""A quality classifier that learns from document labels by attention over passages.

A document is a bag of passages of ``PASSAGE`` words. Every passage of the whole text is encoded: the
frequencies of its bytes, the share of different words and a few other measures, through one learned
layer. A gated attention (Ilse, Tomczak and Welling, 2018) gives each passage a weight, the weighted sum
of the encodings is the document's representation, and a logistic layer scores it.

The model is fitted on the driver on a bounded sample of labelled documents, ``FIT_DOCUMENTS`` of at most
``FIT_BYTES`` each and ``FIT_TOTAL`` together, drawn by hash; it has some ten thousand numbers. All documents are then scored
where they lie. Only the text goes into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map, mix64, utf8
from hetgraph.llm.suffix import _TABLE, _powers
from hetgraph.runtime import materialize

PASSAGE = 64
FIT_DOCUMENTS, FIT_BYTES, FIT_TOTAL = 4_000, 200_000, 1 << 25
ENCODING, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 64, 0.003, 1e-4, 17
MEASURES = 5
#: Bytes of text that are encoded at a time.
PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _pieces(texts: list[bytes]):
    """Consecutive texts of about ``PIECE`` bytes together."""
    first, room = 0, 0
    for i, t in enumerate(texts):
        room += len(t)
        if room >= PIECE:
            yield first, texts[first : i + 1]
            first, room = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``256 + MEASURES`` numbers per passage, and the number of passages of each text."""
    t = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    size = np.array([len(x) + 1 for x in texts])
    doc = np.repeat(np.arange(len(texts)), size)
    space = _SPACE[t]
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    if not len(begins):
        return np.zeros((0, 256 + MEASURES), np.float32), np.zeros(len(texts), np.int64)
    owner = doc[begins]
    words = np.bincount(owner, minlength=len(texts))
    bags = -(-words // PASSAGE)
    start_of = np.cumsum(words) - words
    passage = (np.cumsum(bags) - bags)[owner] + (np.arange(len(begins)) - start_of[owner]) // PASSAGE
    n = int(bags.sum())
    count = np.bincount(passage, minlength=n)
    with np.errstate(over="ignore"):
        base, inverse = _powers(len(t) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[t] * base[: len(t)], dtype=np.uint64)])
        value = mix64((sums[ends] - sums[begins]) * inverse[begins] + (passage + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # Different words: first places of each value.
    order = np.argsort(value)
    new = np.concatenate([[True], value[order[1:]] != value[order[:-1]]])
    different = np.bincount(passage[order[new]], minlength=n)
    of_byte = np.repeat(passage, ends - begins)
    letters = t[~space]
    counts = np.bincount(of_byte * 256 + letters, minlength=n * 256).reshape(n, 256)
    total = counts.sum(axis=1)
    out = np.empty((n, 256 + MEASURES), np.float32)
    out[:, :256] = np.sqrt(counts / total[:, None])
    upper, lower = counts[:, 65:91].sum(axis=1), counts[:, 97:123].sum(axis=1)
    out[:, 256] = different / count
    out[:, 257] = total / count / 10
    out[:, 258] = upper / np.maximum(upper + lower, 1)
    out[:, 259] = count / PASSAGE
    out[:, 260] = lower / total
    return out, bags


class Model:
    """Encoding, gated attention and scoring layer, with their gradients."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d, h, a = 256 + MEASURES, ENCODING, ATTENTION
        make = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {
            "W": make(d, h), "b": np.zeros(h, np.float32), "V": make(h, a), "U": make(h, a), "w": make(a),
            "c": make(h), "o": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, bags: np.ndarray):
        p = self.p
        enc = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(enc @ p["V"]), 1 / (1 + np.exp(-(enc @ p["U"])))
        logit = (v * u) @ p["w"]
        full = np.flatnonzero(bags)
        starts = (np.cumsum(bags) - bags)[full]
        z = np.zeros((len(bags), ENCODING), np.float32)
        weight = np.zeros(len(x), np.float32)
        if len(full):
            row = np.repeat(np.arange(len(full)), bags[full])
            weight = np.exp(logit - np.maximum.reduceat(logit, starts)[row])
            weight /= np.add.reduceat(weight, starts)[row]
            z[full] = np.add.reduceat(enc * weight[:, None], starts, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["o"])))
        return score, (enc, v, u, weight, z)

    def gradients(self, x, bags, y):
        p, (score, (enc, v, u, weight, z)) = self.p, self.forward(x, bags)
        d_out = (score - y) / len(y)
        d_z = d_out[:, None] * p["c"]
        row = np.repeat(np.arange(len(bags)), bags)
        d_weight = (enc * d_z[row]).sum(axis=1)
        mean = np.bincount(row, weight * d_weight, len(bags)).astype(np.float32)
        d_logit = weight * (d_weight - mean[row])
        d_gate = d_logit[:, None] * p["w"]
        d_v, d_u = d_gate * u * (1 - v * v), d_gate * v * u * (1 - u)
        d_enc = weight[:, None] * d_z[row] + d_v @ p["V"].T + d_u @ p["U"].T
        d_pre = d_enc * (1 - enc * enc)
        return {
            "W": x.T @ d_pre, "b": d_pre.sum(axis=0), "V": enc.T @ d_v, "U": enc.T @ d_u, "w": (v * u).T @ d_logit,
            "c": z.T @ d_out, "o": d_out.sum(keepdims=True),
        }

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
        """Adam over batches of documents in a fixed random order."""
        rng, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        starts = np.cumsum(bags) - bags
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                some, step = order[at : at + BATCH], step + 1
                rows = np.concatenate([np.arange(starts[i], starts[i] + bags[i]) for i in some])
                for k, g in self.gradients(x[rows], bags[some], y[some]).items():
                    g = g + DECAY * self.p[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = (self.p[k] - RATE * change).astype(np.float32)
        return self


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from fitting. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """The model of at most ``most`` labelled documents that are not held out.

    Of several texts with one doc_id the shortest counts. Without labels of both kinds the model stays as it starts. Labels
    without a quality are ignored.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out())
    drawn = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    drawn = drawn.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(most)
    texts = docs.select("doc_id", utf8().alias("text")).where(F.length("text") <= FIT_BYTES)
    # Written, so that the documents are read once; one text per document.
    known = ["h", "doc_id", "quality"]
    least = F.min(F.struct(F.length("text").alias("size"), "text")).alias("least")
    sample = materialize(
        texts.join(F.broadcast(drawn), "doc_id").groupBy(known).agg(least).select(*known, "least.size", "least.text"), "fit"
    )
    # As many in drawn order as fit into the sum of bytes.
    sizes = sorted(tuple(r) for r in sample.select("h", "doc_id", "size").collect())
    last = sum(1 for total in accumulate(size for _, _, size in sizes) if total <= FIT_TOTAL)
    rows = []
    if last:
        h, doc_id, _ = sizes[last - 1]
        within = (F.col("h") < h) | ((F.col("h") == h) & (F.col("doc_id") <= doc_id))
        rows = sorted(sample.where(within).select(*known, "text").collect(), key=lambda r: (r["h"], r["doc_id"]))
    model = Model()
    if len({r["quality"] for r in rows}) == 2:
        found = [encode_passages(part) for _, part in _pieces([bytes(r["text"]) for r in rows])]
        x, bags = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        model.fit(x, bags, np.array([r["quality"] for r in rows], np.float32))
    return model


def _score(model: Model):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            for first, texts in _pieces(b["text"].to_pylist()):
                x, bags = encode_passages(texts)
                score = model.forward(x, bags)[0].astype(np.float64)
                rows = slice(first, first + len(texts))
                yield {"doc_id": b["doc_id"][rows.start : rows.stop], "held_out": b["held_out"][rows.start : rows.stop], "score": score}

    return run


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs (doc_id, text, ...)``.

    A null, empty or blank text has no passages and gets the score of the empty representation. Null ids and
    repeated rows are rows like all others; other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), utf8().alias("text"))
    scored = arrow_map(rows, _score(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
