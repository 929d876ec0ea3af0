"""Hashes of any substring of a buffer, and sliding minima, in numpy."""

from __future__ import annotations

import numpy as np

# An odd multiplier, its inverse modulo 2 ** 64, and the finalising constants of MurmurHash3.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


class Hasher:
    """Polynomial hashes modulo 2 ** 64 over randomly coded bytes.

    ``load`` a buffer of up to ``limit`` bytes; ``hash(start, end)`` then takes
    arrays of places and depends on the bytes between them only.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.code = np.random.default_rng(20240607).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers, self.inverses = _powers(BASE, limit + 1), _powers(INVERSE, limit + 1)

    def load(self, data: np.ndarray) -> None:
        if len(data) > self.limit:
            raise ValueError(f"{len(data)} bytes exceed the limit of {self.limit}")
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * self.powers[: len(data)], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.inverses[start])

    def grams(self, length: int) -> np.ndarray:
        """Hashes of the ``length`` bytes at every place that has as many."""
        n = max(0, len(self.prefix) - length)
        return mixed((self.prefix[length:] - self.prefix[:n]) * self.inverses[:n])


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit; changes and returns ``values``."""
    for constant in MIX:
        values ^= values >> np.uint64(33)
        values *= np.uint64(constant)
    values ^= values >> np.uint64(33)
    return values


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, by doubling."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    return out if reach == width else np.minimum(out[: len(values) - width + 1], out[width - reach :])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)
