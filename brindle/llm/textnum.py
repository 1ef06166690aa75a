"""Whole batches of texts as numpy arrays: words, lines, hashes and windows.

Every function works on the concatenated UTF-8 bytes of many documents at once, so a
document costs no Python loop. Hashes of byte strings are multilinear (each byte's random
64-bit value times a random odd multiplier of its place), finished by a mixer; two different
strings collide with a probability near 2**-64, also for strings built against plain
polynomial hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit values that depend on seed only."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


BYTE = stream(256, 11)
_places = stream(1 << 12, 23) | U64(1)


def places(n: int) -> np.ndarray:
    global _places
    if n > len(_places):
        _places = stream(max(n, 2 * len(_places)), 23) | U64(1)
    return _places


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table with False for the bytes in the ranges (ends included) and True for others."""
    keep = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        keep[lo : hi + 1] = False
    return keep


#: Bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing.
ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Texts:
    """Some rows of a string column as bytes: ``buf`` holds the texts one after another, row i at ``start[i]:end[i]``. A null is an empty text."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.buf, self.start, self.end = buf, start, end

    def __len__(self) -> int:
        return len(self.start)

    @property
    def length(self) -> np.ndarray:
        return self.end - self.start

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, at, side="right") - 1

    def sums(self, flag: np.ndarray) -> np.ndarray:
        """Per row, how many of its bytes have the flag."""
        c = np.zeros(len(flag) + 1, dtype=np.int64)
        np.cumsum(flag, out=c[1:])
        return c[self.end] - c[self.start]


def texts(col: pa.Array) -> Texts:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n, at = len(col), col.offset
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if n == 0 or offsets is None:
        z = np.zeros(n, dtype=np.int64)
        return Texts(np.zeros(0, dtype=np.uint8), z, z)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    off = off - off[0]
    return Texts(buf, off[:-1], off[1:])


def pieces(t: Texts, most: int = 1 << 20) -> Iterator[tuple[int, int, Texts]]:
    """Runs of rows with at most ``most`` bytes together, or a single longer row: first row, last row (excluded), texts."""
    i, n = 0, len(t)
    while i < n:
        j = max(i + 1, int(np.searchsorted(t.end, t.start[i] + most, side="right")))
        lo, hi = int(t.start[i]), int(t.end[j - 1])
        yield i, j, Texts(t.buf[lo:hi], t.start[i:j] - lo, t.end[i:j] - lo)
        i = j


def spans(t: Texts, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in the class ``keep`` inside a row: start, end, row."""
    on = keep[t.buf]
    n = len(on)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    edge = np.zeros(n + 1, dtype=bool)
    edge[t.start] = True
    edge[t.end] = True
    first = on.copy()
    first[1:] &= ~on[:-1] | edge[1:n]
    last = on.copy()
    last[:-1] &= ~on[1:] | edge[1:n]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, t.row_of(s)


def hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the byte strings buf[s:e]; they don't overlap and come in order."""
    if not len(s):
        return np.zeros(0, dtype=U64)
    n = e - s
    some = n > 0
    n1, s1 = n[some], s[some]
    out = np.zeros(len(s), dtype=U64)
    if len(n1):
        at = np.zeros(len(n1), dtype=np.int64)
        np.cumsum(n1[:-1], out=at[1:])
        k = np.arange(int(n1.sum()), dtype=np.int64) - np.repeat(at, n1)
        v = BYTE[buf[np.repeat(s1, n1) + k]] * places(int(n1.max()))[k]
        out[some] = np.add.reduceat(v, at)
    return mix(out + n.astype(U64) * U64(0xD6E8FEB86659FD93))


GRAM = stream(64, 37) | U64(1)


def grams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of n consecutive words of a row: index of the first word, and a hash that also depends on the row."""
    if len(h) < n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    at = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
    g = (row[at].astype(U64) + U64(1)) * U64(0xA0761D6478BD642F)
    for j in range(n):
        g = g + h[at + j] * GRAM[j]
    return at, mix(g)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys stand in the array more than once."""
    n = len(keys)
    if n < 2:
        return np.zeros(n, dtype=bool)
    bits = max(10, int(2 * n).bit_length())
    slot = (keys & U64((1 << bits) - 1)).astype(np.int64)
    out = np.bincount(slot, minlength=1 << bits)[slot] > 1
    at = np.flatnonzero(out)
    k = keys[at]
    order = np.argsort(k)
    k = k[order]
    same = k[1:] == k[:-1]
    dup = np.zeros(len(k), dtype=bool)
    dup[1:] |= same
    dup[:-1] |= same
    out[at[order]] = dup
    return out


def later(keys: np.ndarray) -> np.ndarray:
    """Which of the keys stand in the array before, too."""
    out = repeated(keys)
    at = np.flatnonzero(out)
    _, first = np.unique(keys[at], return_index=True)
    out[at[first]] = False
    return out


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Flags of the places 0 to size-1 that windows of n places starting at ``at`` cover."""
    d = np.bincount(at, minlength=size + 1)[: size + 1] - np.bincount(at + n, minlength=size + 1)[: size + 1]
    return np.cumsum(d)[:size] > 0
