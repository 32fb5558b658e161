"""Vector columns: arrays of numbers, kept as arrays at every public edge.

Elementwise work is built from higher-order functions and stays in the JVM. Only matrix
products go through Arrow, one numpy product per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401  (public)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAKY_SLOPE = 0.2
NORM_EPS = 1e-5


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _double(c: str | Column) -> Column:
    return _col(c).cast("array<double>")


def _fold(vec: Column, step: Callable[[Column, Column], Column], start: float = 0.0) -> Column:
    return F.aggregate(vec, F.lit(start), step)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """Bind a value so that a lambda inside ``f`` reads it instead of computing it per element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def vec_sum(vec: str | Column) -> Column:
    return _fold(_double(vec), lambda a, x: a + x)


def l2_normalize(vec: str | Column) -> Column:
    """Scale to unit length; a zero vector stays as it is, null stays null."""
    v = _double(vec)
    scaled = let(
        F.sqrt(_fold(v, lambda a, x: a + x * x)),
        lambda norm: F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v),
    )
    return F.when(_col(vec).isNotNull(), scaled)


def softmax(vec: str | Column) -> Column:
    v = _double(vec)
    powers = let(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))
    return let(
        powers, lambda p: let(vec_sum(p), lambda total: F.transform(p, lambda x: x / total))
    )


def argmax(vec: str | Column) -> Column:
    """0-based place of the largest value, the first one on ties."""
    v = _col(vec)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def relu(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(F.lit(0.0))


def elu(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(F.exp(x) - 1)


def leaky_relu(x: Column, slope: float = LEAKY_SLOPE) -> Column:
    return F.when(x > 0, x).otherwise(x * slope)


ACTIVATIONS: dict[str, Callable[[Column], Column]] = {"relu": relu, "elu": elu, "leaky_relu": leaky_relu}


def activate(vec: str | Column, activation: str | Callable[[Column], Column]) -> Column:
    f = ACTIVATIONS[activation] if isinstance(activation, str) else activation
    return F.transform(_double(vec), lambda x: f(x))


def layer_norm(
    vec: str | Column,
    gamma: Sequence[float] | None = None,
    beta: Sequence[float] | None = None,
    eps: float = NORM_EPS,
) -> Column:
    """Zero mean and unit (population) variance over the vector, then scale and shift."""
    v = _double(vec)
    n = F.size(v).cast("double")
    centred = let(vec_sum(v) / n, lambda mean: F.transform(v, lambda x: x - mean))
    scaled = let(
        centred,
        lambda c: let(
            F.sqrt(_fold(c, lambda a, x: a + x * x) / F.size(c).cast("double") + eps),
            lambda spread: F.transform(c, lambda x: x / spread),
        ),
    )
    if gamma is not None:
        scaled = F.zip_with(scaled, F.array(*[F.lit(float(g)) for g in gamma]), lambda a, b: a * b)
    if beta is not None:
        scaled = F.zip_with(scaled, F.array(*[F.lit(float(b)) for b in beta]), lambda a, c: a + c)
    return scaled


# --- vectors per group --------------------------------------------------------------------

# Dimensions that one aggregation handles side by side. Generated code stays small below it;
# longer vectors are cut into pieces of this length, aggregated, and put together again.
WIDTH = 64

_REDUCERS = {"sum": F.sum, "mean": F.sum, "max": F.max, "min": F.min}


def _entry(vec: str, i: int) -> Column:
    """Entry ``i``, which must be there."""
    return F.coalesce(F.get(vec, F.lit(i)).cast("double"), F.raise_error(F.lit("a vector has a null entry or is too short")))


def of_length(vec: str | Column, dim: int) -> Column:
    """The vector, if it has ``dim`` entries; any other vector, null included, ends the job with an error."""
    wrong = F.concat(F.lit(f"a vector does not have {dim} entries but "), F.coalesce(F.size(_col(vec)), F.lit(-1)).cast("string"))
    return F.when(F.size(_col(vec)) == dim, _col(vec)).otherwise(F.raise_error(wrong))


def _join_pieces(pieces: DataFrame, keys: list[str], name: str, *more: Column) -> DataFrame:
    """One vector per key out of its few pieces ``__p, __v``, each of its true length."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("__p", "__v"))), lambda x: x["__v"])
    return pieces.groupBy(*keys).agg(*more, F.flatten(ordered).alias(name))


def reduce_by(
    rows: DataFrame, keys: list[str], vec: str, dim: int, how: str = "sum", name: str = "m", width: int = WIDTH, times: str | None = None
) -> DataFrame:
    """Elementwise sum, mean, max or min of a vector column: ``keys, n, <name>``. With ``times`` a row stands for that many.

    One aggregate per dimension, combined on the map side. A mean is a sum over a shared
    count, since an average per dimension would shuffle ``dim`` counts. Every vector must have
    exactly ``dim`` entries and none of them null; anything else is an error, never a cut.
    """
    if how not in _REDUCERS:
        raise ValueError(f"unknown reduction {how!r}; known: {sorted(_REDUCERS)}")
    count = (F.count(F.lit(1)) if times is None else F.sum("__times")).alias("n")
    held = [] if times is None else [F.col(times).alias("__times")]
    rows = rows.select(*keys, *held, of_length(vec, dim).alias("__x"))
    weighted = times is not None and how in ("sum", "mean")

    def entry(i):
        return _entry("__x", i) * F.col("__times") if weighted else _entry("__x", i)

    def as_vector(length):
        parts = [F.col(f"__s{i}") for i in range(length)]
        return F.array(*[p / F.col("n") if how == "mean" else p for p in parts])

    if dim <= width:
        sums = [_REDUCERS[how](entry(i)).alias(f"__s{i}") for i in range(dim)]
        return rows.groupBy(*keys).agg(count, *sums).select(*keys, "n", as_vector(dim).alias(name))
    cut = F.array(*[F.slice("__x", start + 1, width) for start in range(0, dim, width)])
    # The last piece is shorter: what it does not have is null here and cut off by its length.
    sums = [_REDUCERS[how](F.when(F.size("__x") > i, entry(i))).alias(f"__s{i}") for i in range(width)]
    pieces = (
        rows.select(*keys, *(["__times"] if held else []), F.posexplode(cut).alias("__p", "__x"))
        .groupBy(*keys, "__p")
        .agg(count, *sums)
        .select(*keys, "n", "__p", F.slice(as_vector(width), 1, F.least(F.lit(width), dim - F.col("__p") * width)).alias("__v"))
    )
    return _join_pieces(pieces, keys, name, F.max("n").alias("n"))


def weighted_mean_by(
    rows: DataFrame, keys: list[str], vec: str, weights: str, heads: int, dim: int, name: str = "m", width: int = WIDTH
) -> DataFrame:
    """Per head the weighted mean of ``dim`` entries of a vector: ``keys, <name>``.

    ``vec`` holds the heads side by side and ``weights`` one number per head; other lengths and
    null entries are errors.
    """
    total = heads * dim
    rows = rows.select(*keys, of_length(vec, total).alias("__v"), of_length(weights, heads).alias("__w"))
    if total <= width:
        sums = [F.sum(_entry("__v", i) * _entry("__w", i // dim)).alias(f"__s{i}") for i in range(total)]
        norms = [F.sum(_entry("__w", k)).alias(f"__z{k}") for k in range(heads)]
        means = F.array(*[F.col(f"__s{i}") / F.col(f"__z{i // dim}") for i in range(total)])
        return rows.groupBy(*keys).agg(*sums, *norms).select(*keys, means.alias(name))
    cuts = [(k, start, min(width, dim - start)) for k in range(heads) for start in range(0, dim, width)]
    cut = F.array(
        *[
            F.struct(_entry("__w", k).alias("w"), F.slice("__v", k * dim + start + 1, n).alias("x"))
            for k, start, n in cuts
        ]
    )
    longest = min(width, dim)
    length = F.get(F.array(*[F.lit(n) for _, _, n in cuts]), F.col("__p"))
    pieces = (
        rows.select(*keys, F.posexplode(cut).alias("__p", "__x"))
        .groupBy(*keys, "__p")
        .agg(
            F.sum("__x.w").alias("__z"),
            *[
                F.sum(F.when(F.size("__x.x") > i, _entry("__x.x", i) * F.col("__x.w"))).alias(f"__s{i}")
                for i in range(longest)
            ],
        )
        .select(
            *keys, "__p", F.slice(F.array(*[F.col(f"__s{i}") / F.col("__z") for i in range(longest)]), 1, length).alias("__v")
        )
    )
    return _join_pieces(pieces, keys, name)


# --- matrix products ----------------------------------------------------------------------

Linear = tuple[np.ndarray, np.ndarray | None]


def dense(weights: dict[str, Sequence[Linear]], key: str | Column, vec: str | Column, hidden: str = "relu") -> Column:
    """Chain of ``W x + b`` chosen by ``key``, with ``hidden`` between two of them.

    A vector whose key has no weights passes through, null stays null. The weights travel
    with the task: their size is set by the model and does not depend on the data.
    """
    chains = {
        k: [(np.asarray(w, "float64"), None if b is None else np.asarray(b, "float64")) for w, b in chain]
        for k, chain in weights.items()
    }
    between = {
        "relu": lambda x: np.maximum(x, 0.0),
        "elu": lambda x: np.where(x > 0, x, np.expm1(np.minimum(x, 0.0))),
        "leaky_relu": lambda x: np.where(x > 0, x, LEAKY_SLOPE * x),
        "sigmoid": lambda x: 1.0 / (1.0 + np.exp(-x)),
    }[hidden]

    def apply(keys: pa.Array, vectors: pa.Array) -> pa.Array:
        offsets = vectors.offsets.to_numpy()
        values = vectors.values.to_numpy(zero_copy_only=False).astype("float64", copy=False)
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        names = keys.to_numpy(zero_copy_only=False)
        lengths = np.where(valid, offsets[1:] - offsets[:-1], 0)
        groups, out_len = [], lengths.copy()
        for name in set(names[valid]):
            rows = np.flatnonzero((names == name) & valid)
            chain = chains.get(name)
            if chain:
                if (lengths[rows] != chain[0][0].shape[1]).any():
                    raise ValueError(f"{name}: vectors do not have {chain[0][0].shape[1]} entries")
                out_len[rows] = chain[-1][0].shape[0]
            groups.append((rows, chain))
        ends = np.concatenate([[0], np.cumsum(out_len)])
        out = np.empty(ends[-1], "float64")

        def gather(rows, size):
            return values[offsets[rows][:, None] + np.arange(size)]

        for rows, chain in groups:
            if not chain:
                for size in np.unique(lengths[rows]):
                    same = rows[lengths[rows] == size]
                    if size:
                        out[ends[same][:, None] + np.arange(size)] = gather(same, size)
                continue
            x = gather(rows, chain[0][0].shape[1])
            for i, (w, b) in enumerate(chain):
                x = x @ w.T if b is None else x @ w.T + b
                if i + 1 < len(chain):
                    x = between(x)
            out[ends[rows][:, None] + np.arange(x.shape[1])] = x
        return pa.ListArray.from_arrays(
            pa.array(ends.astype("int32")), pa.array(out), mask=pa.array(~valid)
        )

    # Annotations are looked up by name when they are text, so they are set as objects here.
    apply.__annotations__ = {"keys": pa.Array, "vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "array<double>")(_col(key), _double(vec))
