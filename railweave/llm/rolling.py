"""Hashes of substrings of a byte array from prefix sums, for numpy code inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << bits, _BASE, np.uint64), np.full(1 << bits, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Prefix:
    """``hash(start, end)`` of any ranges of ``data``: equal bytes, equal hash, wherever they stand."""

    def __init__(self, data: np.ndarray):
        bits = max(16, int(len(data)).bit_length())
        self.up, self.down = _powers(bits)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[:len(data)], out=self.sums[1:])

    def hash(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, width: int) -> np.ndarray:
        """The hash of each range of ``width`` bytes."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of bytes that are no ASCII white space starts and ends."""
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]
