"""Suffix arrays by induced sorting on numpy arrays, to the depth that a match length needs.

The text is classified into suffixes that are smaller or larger than their right neighbour; the
leftmost-smaller substrings are sorted by inducing, named, and the order of their suffixes is
found on the shorter string of names; a last induction gives all suffixes (Nong, Zhang and Chan,
2009). The scans go bucket by bucket: what a bucket induces into itself is done in rounds, what it
induces into others is one stable scatter. On the string of names the buckets are too small for
that, so its ranks are refined by doubling, up to ``depth`` bytes, beyond which equal suffixes may
come in any order.
"""

from __future__ import annotations

import numpy as np

from hetgraph.llm.common import mix64


def _scatter(sa, at, preds, chars, step):
    """Append ``preds`` to the buckets of ``chars``, in order; ``at`` moves by ``step`` (1 or -1)."""
    order = np.argsort(chars, kind="stable")
    c, p = chars[order], preds[order]
    counts = np.bincount(c, minlength=256)
    starts = np.cumsum(counts) - counts
    sa[at[c] + step * (np.arange(len(c)) - starts[c])] = p
    at += step * counts


def _induce(t, small, sa, heads, tails, lms_sorted):
    """All suffixes into ``sa``, given leftmost-smaller ones in their order."""
    sa[:] = -1
    chars = t[lms_sorted]
    end = tails.copy()
    _scatter(sa, end, lms_sorted[::-1], chars[::-1], -1)
    large_at = heads.copy()

    def larger(found):
        p = found[found > 0] - 1
        return p[~small[p]]

    def smaller(found):
        p = found[found > 0] - 1
        return p[small[p]]

    last = np.array([len(t) - 1])
    if not small[-1]:
        _scatter(sa, large_at, last, t[last], 1)
    present = np.flatnonzero(tails >= heads)
    for c in present:
        done = heads[c]
        while done < large_at[c]:
            new = sa[done : large_at[c]]
            done = large_at[c]
            p = larger(new)
            _scatter(sa, large_at, p, t[p], 1)
        p = larger(sa[end[c] + 1 : tails[c] + 1])
        if len(p):
            _scatter(sa, large_at, p, t[p], 1)
    small_at = tails.copy()
    if small[-1]:
        _scatter(sa, small_at, last, t[last], -1)
    for c in present[::-1]:
        done = tails[c]
        while done > small_at[c]:
            new = sa[small_at[c] + 1 : done + 1][::-1]
            done = small_at[c]
            p = smaller(new)
            _scatter(sa, small_at, p, t[p], -1)
        p = smaller(sa[heads[c] : large_at[c]][::-1])
        if len(p):
            _scatter(sa, small_at, p, t[p], -1)


def _names(t, lms, order):
    """A number per leftmost-smaller substring (to the next one's first byte), equal for equal ones."""
    ends = np.append(lms[1:] + 1, len(t))
    with np.errstate(over="ignore"):
        base, inverse = _powers(len(t) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[t] * base[: len(t)], dtype=np.uint64)])
        value = mix64((sums[ends] - sums[lms]) * inverse[lms] + (ends - lms).astype(np.uint64))
    new = np.empty(len(order), np.int64)
    new[0] = 0
    new[1:] = value[order[1:]] != value[order[:-1]]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return names


#: A fixed odd multiplier, its inverse modulo 2 ** 64, and a fixed number for each byte.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
with np.errstate(over="ignore"):
    _TABLE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
_cache: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("base", ())) < n:
        size = 1 << int(n - 1).bit_length()
        for name, x in (("base", _BASE), ("inverse", _INVERSE)):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _cache[name] = np.multiply.accumulate(steps)
    return _cache["base"], _cache["inverse"]


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``t`` (unsigned bytes) in the order of their suffixes, up to ``depth`` bytes."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    # A suffix is small if it is below its right neighbour; the last one is large. A byte that equals the next has its type.
    step = np.sign(t[1:].astype(np.int16) - t[:-1])
    where = np.where(step != 0, np.arange(n - 1), n)
    ahead = np.minimum.accumulate(where[::-1])[::-1]
    small = np.zeros(n, bool)
    known = ahead < n
    small[:-1][known] = step[ahead[known]] > 0
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(t, minlength=256)
    tails = np.cumsum(counts) - 1
    heads = tails - counts + 1
    sa = np.empty(n, np.int64)
    if len(lms):
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        _induce(t, small, sa, heads, tails, lms[np.argsort(t[lms], kind="stable")])
        rank_of = np.empty(n, np.int64)
        rank_of[lms] = np.arange(len(lms))
        order = rank_of[sa[is_lms[sa]]]
        names = _names(t, lms, order)
        h = 1
        while names.max() + 1 < len(lms) and 2 * h < 2 * depth:
            key = names * (len(lms) + 1)
            key[:-h] += names[h:] + 1
            order = np.argsort(key)
            new = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
            names = np.empty(len(lms), np.int64)
            names[order] = new
            h *= 2
            if h >= len(lms):
                break
        lms = lms[np.argsort(names, kind="stable")]
    _induce(t, small, sa, heads, tails, lms)
    return sa


def _words(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, the first byte lowest; zeros behind the end."""
    n = len(t)
    padded = np.concatenate([t, np.zeros(16, np.uint8)])
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        m = len(range(k, n, 8))
        out[k::8] = padded[k : k + 8 * m].view("<u8")
    return out


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, up to ``most``."""
    n, out, one = len(words), np.zeros(len(a), np.int64), np.uint64(1)
    live = np.arange(len(a))
    with np.errstate(over="ignore"):
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            room = np.minimum(n - np.maximum(x, y), most - out[live])
            if (room <= 0).any():
                ok = room > 0
                live, x, y, room = live[ok], x[ok], y[ok], room[ok]
            differ = words[x] ^ words[y]
            # Bits below the lowest one that differs; all 64 if none does.
            equal = np.minimum(np.bitwise_count((differ & (~differ + one)) - one) // 8, room)
            out[live] += equal
            live = live[equal == 8]
    return out


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position, in text order, the common prefix with the suffix before it in ``sa``.

    Only where the bytes before the two suffixes differ is it compared; elsewhere it is one less
    than at the position before. Lengths from ``most`` on are not told apart.
    """
    n = len(t)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[1:] == before[:-1] + 1) & (t[:-1] == t[before[1:] - 1])
    words = _words(t)
    start = np.flatnonzero(~follows & (before >= 0))
    out = np.zeros(n, np.int64)
    # Looking further than ``most`` here saves comparisons below.
    out[start] = _common(words, start, before[start], 2 * most)
    head = np.maximum.accumulate(np.where(~follows, i, 0))
    cut = out[head] >= 2 * most
    out = np.where(follows, out[head] - (i - head), out)
    again = np.flatnonzero(follows & cut & (out < most))
    if len(again):
        out[again] = _common(words, again, before[again], most)
    return out


def repeated_starts(t: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each position start with a total weight of two or more.

    ``weight`` is zero where no string of that length starts.
    """
    sa = suffix_array(t, length)
    common = permuted_common_prefixes(t, sa, length)
    group = np.cumsum(common[sa] < length)
    totals = np.bincount(group, weights=weight[sa])
    out = np.zeros(len(t), bool)
    out[sa] = totals[group] >= 2
    return out & (weight > 0)
