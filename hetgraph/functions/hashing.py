"""Seeded randomness that depends on the row's key alone.

``rand(seed)`` and ``sample`` follow the partition layout, so a retry or another cluster size
changes the draw. Here a draw is the first 52 bits of an md5 over ``seed:key...``: the same
row always gets the same number, on any engine, and 52 bits are exact in a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 52
_SPAN = float(1 << BITS)


def _part(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def hash52(*key) -> Column:
    """Uniform long in [0, 2^52). Columns are taken as they are, other values as literals."""
    text = F.concat_ws(":", *[_part(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def uniform(*key) -> Column:
    """Uniform double in [0, 1)."""
    return hash52(*key).cast("double") / F.lit(_SPAN)


def draw_positions(size: Column, k: int | Column, *key) -> Column:
    """``min(k, size)`` distinct positions out of ``0 .. size-1``, uniform over all subsets.

    Floyd's subset sampling (Bentley and Floyd, CACM 30(9), 1987): work grows with k and
    not with ``size``, so a node with a billion neighbours costs as much as one with twenty.
    """
    k = (k if isinstance(k, Column) else F.lit(k)).cast("long")
    size = size.cast("long")
    zero = F.lit(0).cast("long")
    steps = F.transform(
        F.sequence(F.greatest(size - k, zero), size - 1),
        lambda j: F.struct(j.alias("j"), F.pmod(hash52(*key, j), j + 1).alias("t")),
    )
    drawn = F.aggregate(
        steps,
        F.array().cast("array<bigint>"),
        lambda acc, x: F.concat(
            acc, F.array(F.when(F.array_contains(acc, x["t"]), x["j"]).otherwise(x["t"]))
        ),
    )
    empty = F.array().cast("array<bigint>")
    return (
        F.when((size <= 0) | (k <= 0), empty)
        .when(size <= k, F.sequence(zero, size - 1))
        .otherwise(drawn)
    )
