"""Vectorised hashes of words, prefixes and n-grams over the bytes of many texts at once.

The hash of bytes s..e of a buffer is (P[e] - P[s]) * B^-s modulo 2^64, P being the running sum of T[byte] * B^i with a table T of random
64-bit values; every substring's hash so costs two reads. n-gram hashes of ready unit hashes are built by doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEED = 20240607
B = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
CHUNK_BYTES = 1 << 18


def byte_table(seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash's entropy over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


class Prefixes:
    """Running sums over a buffer; the power tables are kept and grown from one buffer to the next."""

    def __init__(self, seed: int = SEED) -> None:
        self.table = byte_table(seed)
        self.up = self.down = np.ones(1, np.uint64)
        self.sums = np.zeros(1, np.uint64)

    def load(self, body: np.ndarray) -> Prefixes:
        n = len(body) + 1
        if len(self.up) < n:
            self.up, self.down = powers(B, n), powers(pow(B, -1, 1 << 64), n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.table[body] * self.up[: n - 1], out=self.sums[1:])
        return self

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.cumprod(x, dtype=np.uint64)


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs outside [\\x20\\x09-\\x0D], none across rows, and the n + 1 word offsets of the rows."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    inside = ~space[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def gram(units: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k units (unmixed); empty if there are fewer."""
    n = len(units) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, cur, width = None, 0, units, 1
    while True:
        if k & width:
            out = cur[:n] if out is None else out[:n] * np.uint64(multiplier(width + 64)) + cur[done : done + n]
            done += width
        if done == k:
            return out[:n].copy() if out is units or out.base is units else out
        cur = cur[:-width] * np.uint64(multiplier(width)) + cur[width:]
        width *= 2


def multiplier(i: int) -> int:
    x = (i + 1) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 30) * 0x94D049BB133111EB & MASK
    return (x ^ x >> 31) | 1


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    width, cur = 1, x
    while width * 2 <= w:
        cur = np.minimum(cur[:-width], cur[width:])
        width *= 2
    return np.minimum(cur[:n], cur[w - width : w - width + n])
