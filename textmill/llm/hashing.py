"""Rolling polynomial hashes modulo 2**64 over numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _series(factor: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(factor), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse."""
    size = 1 << max(16, (n - 1).bit_length())
    if not _tables or size > next(iter(_tables)):
        _tables.clear()
        _tables[size] = (_series(_BASE, size), _series(pow(_BASE, -1, 1 << 64), size))
    return next(iter(_tables.values()))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of values[i : i + width] for every i; values are 64-bit, well spread."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[width:] - total[:n]) * down[:n])


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 1_000_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
