"""XXH64 (public specification) of many short byte strings at once."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Fixed values of the algorithm.
P1, P2, P3, P4, P5 = (U64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rot(acc + lane * P2, 31) * P1


def xxh64(buf: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """The hash of each buf[start:start+size]; strings may overlap."""
    with np.errstate(over="ignore"):
        padded = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
        at8 = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        lane = lambda i: at8[i]
        p, left = start.astype(np.int64), size.astype(np.int64)
        h = np.full(len(p), seed, dtype=U64) + P5
        if len(big := np.flatnonzero(left >= 32)):
            s = U64(seed)
            v = [np.full(len(big), x, dtype=U64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            q, stripes = p[big], left[big] // 32
            act = np.arange(len(big))
            k = 0
            while len(act):
                for j in range(4):
                    v[j][act] = _round(v[j][act], lane(q[act] + 32 * k + 8 * j))
                k += 1
                act = act[stripes[act] > k]
            m = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
            for x in v:
                m = (m ^ _round(np.zeros(len(big), dtype=U64), x)) * P1 + P4
            h[big] = m
            p = p.copy()
            p[big] += 32 * stripes
            left = left.copy()
            left[big] -= 32 * stripes
        h = h + size.astype(U64)
        for k in range(3):
            a = np.flatnonzero(left >= 8 * (k + 1))
            if not len(a):
                break
            h[a] = _rot(h[a] ^ _round(np.zeros(len(a), dtype=U64), lane(p[a] + 8 * k)), 27) * P1 + P4
        p, left = p + (left & ~7), left & 7
        a = np.flatnonzero(left >= 4)
        h[a] = _rot(h[a] ^ ((lane(p[a]) & U64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        p, left = p + (left & 4), left & 3
        for k in range(3):
            a = np.flatnonzero(left > k)
            if not len(a):
                break
            h[a] = _rot(h[a] ^ (padded[p[a] + k].astype(U64) * P5), 11) * P1
        h = (h ^ (h >> U64(33))) * P2
        h = (h ^ (h >> U64(29))) * P3
        return h ^ (h >> U64(32))
