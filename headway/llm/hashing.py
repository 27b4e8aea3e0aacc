"""Hashes of byte ranges by array operations."""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20  # bytes hashed at once
TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
MASK = (1 << 64) - 1


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_OTHER, SEGMENT + 1), _powers(pow(_OTHER, -1, 1 << 64), SEGMENT + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def range_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the ranges [first, end) of at most a segment of bytes."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(TABLE[data] * _UP[: len(data)])))
    return (sums[end] - sums[first]) * _DOWN[first]
