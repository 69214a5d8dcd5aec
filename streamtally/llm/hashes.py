"""Hashes of spans of an array, for many spans at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
ASCII_WHITE = (9, 10, 11, 12, 13, 32)


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^k and BASE^-k modulo 2^64 for k < n at least; one table per worker, which grows as needed."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        _powers.clear()
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers.append(np.multiply.accumulate(out))
    return _powers[0], _powers[1]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Order-sensitive hash of values[start:end]; value k stands at place[k], else at k."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    n = len(values)
    np.cumsum(values * (up[:n] if place is None else up[place[:n]]), out=sums[1:])
    return (sums[end] - sums[start]) * down[start if place is None else place[start]]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def byte_noise() -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each white-space separated word of each text, and the text it is in."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    inside = np.zeros(len(data) + 2, bool)
    white = np.zeros(256, bool)
    white[list(ASCII_WHITE)] = True
    inside[1:-1] = ~white[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    owner = np.searchsorted(first, start, "right") - 1
    return span_hashes(byte_noise()[data], start, end), owner


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; with fewer words, of all its words as one."""
    hashes, owner = words(texts)
    factors = np.random.default_rng(23).integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = np.bincount(owner, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for t in range(k):
        total += padded[t : t + len(hashes)] * factors[t]
    total = mixed(total)
    first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    out = []
    for i, m in enumerate(n.tolist()):
        a = first[i]
        if m >= k:
            out.append(np.unique(total[a : a + m - k + 1]))
        elif m:
            short = np.zeros(1, np.uint64)
            for t in range(m):
                short += hashes[a + t : a + t + 1] * factors[t]
            out.append(mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
