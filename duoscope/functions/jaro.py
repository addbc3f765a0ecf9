"""Jaro similarity / distance (plain Jaro: no common-prefix bonus).

Spark has no Jaro built-in, so the kernel runs inside Arrow batches (``pairs_under``: one
``mapInPandas`` pass that also drops pairs at or above the threshold; ``jaro_distance``: a
``pandas_udf`` column). ``batch_distance`` handles all pairs of a batch at once: each right
title is a mask of places per character, of as many 64-bit words as its length needs, and the loop
runs over character positions, not over pairs. ``jaro_similarity`` is the plain definition for one pair.
The operator in ``operators/link.py`` only sends candidate pairs that survived the lossless
length and character-bag bounds.

Definition: match window ``max(0, max(|x|, |y|) // 2 - 1)``; greedy left-to-right
matching; ``k`` = matched characters out of order; transpositions ``k / 2``
(``k // 2`` when ``floor=True``, the convention of DuckDB's ``jaro_similarity``).
Two empty strings are identical (distance 0); one empty string gives similarity 0.
"""

from __future__ import annotations

import math

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Ship this module's code with the UDF (pickle by value), so Python workers need no
# import path to the package: executors only need pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def jaro_similarity(x: str, y: str, floor: bool = False, min_sim: float | None = None) -> float:
    """Jaro similarity. With ``min_sim``, a pair that provably cannot reach it (too many
    characters of x left unmatched) returns 0.0 early; values >= ``min_sim`` are exact."""
    if x == y:
        return 1.0
    lx, ly = len(x), len(y)
    if lx == 0 or ly == 0:
        return 0.0
    misses_allowed = lx
    if min_sim is not None:
        # (m/lx + m/ly + 1)/3 >= min_sim needs m >= (3 min_sim - 1) / (1/lx + 1/ly)
        need = (3.0 * min_sim - 1.0) / (1.0 / lx + 1.0 / ly) - 1e-9
        misses_allowed = lx - max(0, math.ceil(need))
        if misses_allowed < 0:
            return 0.0
    misses = 0
    window = max(0, max(lx, ly) // 2 - 1)
    # Positions of each character in y, ascending: the greedy rule takes the first
    # unused position inside the window, so only that character's positions are scanned.
    where: dict[str, list[int]] = {}
    for j, ch in enumerate(y):
        where.setdefault(ch, []).append(j)
    y_used = [False] * ly
    x_hits = []
    for i, ch in enumerate(x):
        hit = False
        cand = where.get(ch)
        if cand is not None:
            lo, hi = i - window, i + window
            for j in cand:
                if j < lo:
                    continue
                if j > hi:
                    break
                if not y_used[j]:
                    y_used[j] = True
                    x_hits.append(ch)
                    hit = True
                    break
        if not hit:
            misses += 1
            if misses > misses_allowed:
                return 0.0
    m = len(x_hits)
    if m == 0:
        return 0.0
    y_hits = [y[j] for j in range(ly) if y_used[j]]
    k = sum(1 for a, b in zip(x_hits, y_hits) if a != b)
    t = k // 2 if floor else k / 2.0
    return (m / lx + m / ly + (m - t) / m) / 3.0


def jaro_distance_value(x: str | None, y: str | None, floor: bool = False,
                        digits: int | None = 12, cutoff: float | None = None) -> float | None:
    """1 - Jaro similarity. With ``cutoff``, distances that cannot be below it may be
    reported as 1.0 (callers that only keep ``dist < cutoff`` lose nothing)."""
    if x is None or y is None:
        return None
    min_sim = None if cutoff is None else 1.0 - cutoff
    d = 1.0 - jaro_similarity(x, y, floor, min_sim)
    return round(d, digits) if digits is not None else d


def _codes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points, one row per text, padded with 0; lengths)."""
    size = np.array([len(t) for t in texts], np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(texts), width), np.uint32)
    out[np.arange(width) < size[:, None]] = flat
    return out, size


#: Titles of a batch are handled together by their length: up to 64, 256, 1,024, ... characters.
_WORD, _STEP = 64, 4
#: Words of place masks held at once; longer titles go in smaller groups (one pair at least).
_MASK_WORDS = 1 << 21
_SLACK = 1e-9
#: _ONES[k]: the k lowest bits.
_ONES = np.array([(1 << k) - 1 for k in range(_WORD + 1)], np.uint64)


def batch_distance(xs, ys, floor: bool = False, digits: int | None = 12) -> np.ndarray:
    """1 - Jaro similarity of each pair of titles; NaN where either is missing."""
    out = np.full(len(xs), np.nan)
    some = [i for i in range(len(xs)) if isinstance(xs[i], str) and isinstance(ys[i], str)]
    longest = {i: max(len(xs[i]), len(ys[i])) for i in some}
    top = _WORD
    while some:
        rows = [i for i in some if longest[i] <= top]
        some = [i for i in some if longest[i] > top]
        at = 0
        while at < len(rows):
            found = rows[at:at + 4096]
            d, n = _distances([xs[i] for i in found], [ys[i] for i in found], floor)
            out[found[:n]] = d
            at += n
        top *= _STEP
    return np.round(out, digits) if digits is not None else out


def _numbered(xs: list[str], ys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Characters of both sides numbered from 0 as they occur, padded; lengths; how many there are."""
    width = max(1, max(map(len, xs)), max(map(len, ys)))
    (x, lx), (y, ly) = _codes(xs, width), _codes(ys, width)
    seen = np.zeros(max(int(x.max()), int(y.max())) + 1, bool)
    seen[x], seen[y] = True, True
    number = np.cumsum(seen) - 1
    return number[x], lx, number[y], ly, int(number[-1]) + 1


def _places(y: np.ndarray, ly: np.ndarray, n_chars: int) -> np.ndarray:
    """[title, character, word]: bit j of a title's words is set where y[j] is the character."""
    n, width = y.shape
    out = np.zeros((n, n_chars, -(-width // _WORD)), np.uint64)
    rows = np.arange(n)
    for j in range(width):
        live = j < ly
        out[rows[live], y[live, j], j // _WORD] |= np.uint64(1 << (j % _WORD))
    return out


def _similar(x, lx, y, ly, places, ia, ib, floor: bool, least: float = 0.0) -> np.ndarray:
    """Similarity of the pairs (x[ia], y[ib]); 0 for some that can't reach ``least``.

    The loop runs over the places of the left titles, all pairs at once.
    """
    width, words = x.shape[1], places.shape[2]
    a, b = lx[ia], ly[ib]
    at_place = np.ascontiguousarray(x.T)[:, ia]     # one row per place: the loop reads and writes whole rows
    one, window = np.uint64(1), np.maximum(0, np.maximum(a, b) // 2 - 1)
    used = np.zeros((len(ia), words), np.uint64)
    hit = np.zeros((width, len(ia)), bool)
    first_bit, pairs = np.arange(words) * _WORD, np.arange(len(ia))
    if words == 1:   # reach_at[i, window]: the places that may match place i
        w = np.arange(_WORD)
        i = np.arange(width)[:, None]
        reach_at = _ONES[np.clip(i + w + 1, 0, _WORD)] & ~_ONES[np.clip(i - w, 0, _WORD)]
        masks, mask_at, free_at = places.reshape(-1), at_place + ib * places.shape[1], ~used[:, 0]
    shortest = a.min(initial=width)
    for i in range(int(a.max(initial=0))):
        if words == 1:
            free = masks.take(mask_at[i])
            free &= free_at
            free &= reach_at[i].take(window)
            if i >= shortest:
                free[i >= a] = 0
            first = free & (~free + one)        # the first free place
            free_at ^= first
        else:
            lo, hi = np.maximum(i - window, 0), i + window + 1
            reach = (_ONES[np.clip(hi[:, None] - first_bit, 0, _WORD)]
                     & ~_ONES[np.clip(lo[:, None] - first_bit, 0, _WORD)])
            free = places[ib, at_place[i]] & ~used & reach
            free[i >= a] = 0
            word = (free != 0).argmax(1)
            at = free[pairs, word]
            first = at & (~at + one)
            used[pairs, word] |= first
        hit[i] = first != 0
    if words == 1:
        used = ~free_at[:, None]
    m = hit.sum(0)
    out = np.zeros(len(ia))
    # without any transposition a pair has (m / |x| + m / |y| + 1) / 3
    live = np.flatnonzero((m > 0) & (m * (a + b) >= (3.0 * least - 1.0 - _SLACK) * a * b))
    a, b, m, used = a[live], b[live], m[live], used[live]
    place = np.arange(width)
    taken = (used[:, place // _WORD] >> (place % _WORD).astype(np.uint64)) & one == one
    # matched characters of both sides in their order, pair after pair: m of either side
    differ = x[ia[live]][hit.T[live]] != y[ib[live]][taken]
    k = np.bincount(np.repeat(np.arange(len(live)), m)[differ], minlength=len(live))
    t = k // 2 if floor else k / 2.0
    out[live] = (m / a + m / b + (m - t) / m) / 3.0
    return out


def _distances(xs: list[str], ys: list[str], floor: bool) -> tuple[np.ndarray, int]:
    """Distances of the first pairs, as many as the masks have room for, and their number."""
    words = -(-max(1, max(map(len, xs)), max(map(len, ys))) // _WORD)
    n = max(1, min(len(xs), _MASK_WORDS // (words * (len(set().union(*xs, *ys)) + 1))))
    xs, ys = xs[:n], ys[:n]
    x, lx, y, ly, n_chars = _numbered(xs, ys)
    both = np.arange(n)
    sim = _similar(x, lx, y, ly, _places(y, ly, n_chars), both, both, floor)
    sim[[a == b for a, b in zip(xs, ys)]] = 1.0
    return 1.0 - sim, n


def _tokens(texts: list[str], number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, token) of every character: token = (character, how many of it up to here), numbered."""
    code = np.array([number[c] for t in texts for c in t], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))
    return text, (np.arange(len(code)) - start) * len(number) + code


def _bits(text: np.ndarray, token: np.ndarray, n: int, n_tokens: int) -> np.ndarray:
    """One bit per token of each text, in 64-bit words: (words, texts)."""
    out = np.zeros((n, max(1, -(-n_tokens // 64)) * 8), np.uint8)
    np.bitwise_or.at(out, (text, token // 8), (1 << (token % 8)).astype(np.uint8))
    return np.ascontiguousarray(out.view(np.uint64).T)


#: So many pairs of a cell are compared at once, and so many in the kernel (whose arrays then stay in the CPU's cache).
_PAIRS, _BATCH = 1 << 22, 1 << 12


def close_in_cell(xs: list[str], ys: list[str], max_dist: float, floor: bool = False,
                  digits: int | None = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in xs, place in ys, distance) of all pairs of two lists under ``max_dist``.

    A similarity of 1 - d needs c (|x| + |y|) >= (2 - 3 d) |x| |y| common characters. A title is a
    set of (character, occurrence) tokens; the common characters of a pair are the common bits,
    counted for whole stretches of titles of one length at once. The rest goes to the kernel.
    """
    none = np.zeros(0, np.int64)
    if not xs or not ys:
        return none, none, np.zeros(0)
    number = {c: i for i, c in enumerate(sorted(set().union(*xs, *ys)))}
    (xt, xk), (yt, yk) = _tokens(xs, number), _tokens(ys, number)
    # Only common tokens can match; numbered without gaps.
    common = np.intersect1d(xk, yk)
    sides = []
    for t, k, n in ((xt, xk, len(xs)), (yt, yk, len(ys))):
        at = np.searchsorted(common, k)
        known = at < len(common)
        known[known] = common[at[known]] == k[known]
        sides.append(_bits(t[known], at[known], n, len(common)))
    x_len, y_len = (np.array([len(t) for t in side], np.int64) for side in (xs, ys))
    by_len = np.argsort(y_len, kind="stable")
    y_bits, y_sorted = np.ascontiguousarray(sides[1][:, by_len]), y_len[by_len]
    k = 2.0 - 3.0 * max_dist - 3.0 * _SLACK
    ia, ib = [], []
    for size in np.unique(x_len):
        # c can't exceed the shorter title, which bounds the other's length
        ratio = max(k - 1.0, 0.0)
        lo = np.searchsorted(y_sorted, ratio * size - _SLACK, "left")
        hi = np.searchsorted(y_sorted, size / ratio + _SLACK, "right") if ratio > 0 else len(ys)
        if lo >= hi:
            continue
        total = np.maximum(size + y_sorted[lo:hi], 1)
        need = np.ceil(np.maximum(k, 0.0) * size * y_sorted[lo:hi] / total - _SLACK).astype(np.int64)
        rows = np.flatnonzero(x_len == size)
        step = max(1, _PAIRS // (hi - lo))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            c = np.zeros((len(some), hi - lo), np.uint16)
            for w in range(len(y_bits)):
                c += np.bitwise_count(sides[0][w, some][:, None] & y_bits[w, lo:hi])
            a, b = np.nonzero(c >= need)
            ia.append(some[a])
            ib.append(by_len[lo + b])
    ia, ib = np.concatenate([none, *ia]), np.concatenate([none, *ib])
    x, lx, y, ly, n_chars = _numbered(xs, ys)
    kernel = None
    if len(ys) * n_chars * -(-x.shape[1] // _WORD) <= 4 * _MASK_WORDS:
        # the masks of the right titles serve all their pairs
        masks = _places(y, ly, n_chars)
        names = {t: i for i, t in enumerate({*xs, *ys})}
        x_name, y_name = (np.array([names[t] for t in side]) for side in (xs, ys))

        def kernel(a, b):
            sim = _similar(x, lx, y, ly, masks, a, b, floor, 1.0 - max_dist)
            sim[x_name[a] == y_name[b]] = 1.0
            return np.round(1.0 - sim, digits) if digits is not None else 1.0 - sim
    keep, dist = [], []
    for at in range(0, len(ia), _BATCH):
        a, b = ia[at:at + _BATCH], ib[at:at + _BATCH]
        d = kernel(a, b) if kernel else batch_distance([xs[i] for i in a], [ys[i] for i in b], floor, digits)
        near = d < max_dist
        keep.append(at + np.flatnonzero(near))
        dist.append(d[near])
    keep = np.concatenate([none, *keep])
    return ia[keep], ib[keep], np.concatenate([np.zeros(0), *dist])


def _make_udf(floor: bool, digits: int | None):
    @F.pandas_udf(DoubleType())
    def _jaro_dist(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series(batch_distance(list(xs), list(ys), floor, digits)).replace({np.nan: None}).astype("float64")
    return _jaro_dist


_UDFS: dict = {}


def jaro_distance(x: Column, y: Column, floor: bool = False, digits: int | None = 12) -> Column:
    """1 - Jaro similarity as a vectorised (Arrow) UDF column, rounded to ``digits``
    so float noise cannot flip a threshold test or a tie. NULL where a title is NULL."""
    key = (floor, digits)
    if key not in _UDFS:
        _UDFS[key] = _make_udf(floor, digits)
    return F.nanvl(_UDFS[key](x, y), F.lit(None).cast("double"))


def pairs_under(pairs: DataFrame, a_col: str, b_col: str, max_dist: float,
                floor: bool = False, digits: int | None = 12) -> DataFrame:
    """Rows of ``pairs`` whose Jaro distance is below ``max_dist``, with a ``dist`` column.

    One ``mapInPandas`` pass over Arrow batches: the distance is computed once per pair
    and rejected pairs never return to the JVM.
    """
    schema = StructType(list(pairs.schema.fields) + [StructField("dist", DoubleType(), True)])

    def keep_close(batches):
        for pdf in batches:
            pdf = pdf.assign(dist=batch_distance(pdf[a_col].tolist(), pdf[b_col].tolist(), floor, digits))
            yield pdf[pdf["dist"] < max_dist]

    return pairs.mapInPandas(keep_close, schema)
