"""Words of many texts at once, on their UTF-8 bytes, with a 64-bit hash of each word.

Both word patterns used here separate words by ASCII characters only, so a class of bytes
decides exactly what the pattern over characters decides.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

_ALL = np.arange(256)
#: ``[^\x20\x09-\x0D]+``
SPACED = (_ALL != 0x20) & ~((_ALL >= 0x09) & (_ALL <= 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
LOWER = _ALL.astype(np.uint8)
LOWER[0x41:0x5B] += 0x20

LONG = 48
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    raw: np.ndarray      # bytes (lower-cased if asked for)
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # one past its last byte
    of: np.ndarray       # word range of text i: of[i] .. of[i + 1]
    hash: np.ndarray     # uint64 of each word

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]].tobytes()

    def list_of(self, a: int, b: int) -> list[bytes]:
        return [self.raw[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b])]

    def joined(self, ranges: list[tuple[int, int]]) -> list[bytes]:
        """Of each (a, b) the words a .. b of one text, with one space between two."""
        gap = self.start[1:] - self.end[:-1]
        raw = self.raw.copy()
        raw[self.end[:-1][gap == 1]] = 0x20
        wide = np.append(0, np.cumsum(gap != 1))
        return [b"" if a >= b else raw[self.start[a]:self.end[b - 1]].tobytes() if wide[a] == wide[b - 1]
                else b" ".join(self.list_of(a, b)) for a, b in ranges]


def split_words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool, hashed: bool = True) -> Words:
    """Words of the texts raw[offsets[i]:offsets[i+1]]; no word crosses two texts. Hashes only if asked for."""
    if lower:
        raw = LOWER[raw]
    n = len(raw)
    inside = table[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1] | edge[1:n]
        last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets),
                 _hashes(raw, start, end) if hashed else np.zeros(0, np.uint64))


def _hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    out = size.astype(np.uint64) + np.uint64(1)
    # by size, so that the words with a further byte are always the last ones
    short = np.minimum(size, LONG + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    upto = np.searchsorted(short[order], np.arange(LONG + 1, dtype=np.uint8), "right")
    n = int(upto[LONG])
    order = order[:n]
    at, h = start[order], out[order]
    for lo in upto[:LONG].tolist():
        if lo == n:
            break
        part = h[lo:]
        part ^= raw[at[lo:]]
        part *= _MUL
        part ^= part >> np.uint64(29)
        at[lo:] += 1
    out[order] = h
    for i in np.flatnonzero(size > LONG):
        digest = hashlib.blake2b(raw[start[i]:end[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return mix(out)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words; run i starts at word i (runs may cross texts)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = (out + hashes[j:j + n]) * _MUL
        out ^= out >> np.uint64(31)
    return out


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Mask of the hashes that are a minimum of some window of w neighbours (ties: all)."""
    n = len(hashes)
    chosen = np.zeros(n, bool)
    m = n - w + 1
    if m <= 0:
        return chosen
    low = hashes[:m].copy()
    for j in range(1, w):
        np.minimum(low, hashes[j:j + m], out=low)
    for j in range(w):
        chosen[j:j + m] |= hashes[j:j + m] == low
    return chosen
