"""Vectorised words of many texts: boundaries, 64-bit hashes, rolling window hashes (numpy).

All arithmetic is modulo 2^64. A word's hash is its polynomial hash, taken from prefix sums
over the block (``(H[end] - H[start]) * B^-start``) and then mixed; a window's hash is the same
Rabin-Karp scheme over word hashes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F

WHITE = np.ones(256, bool)  # bytes of words that white space separates: [^\x20\x09-\x0D]
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """``data`` with A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) on uint64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(b: int) -> np.ndarray:
        out = np.full(size, b, U)
        out[0] = 1
        return np.cumprod(out, dtype=U)

    return powers(base), powers(pow(base, -1, 1 << 64))


def _room(n: int) -> int:
    return 1 << max(12, int(n).bit_length())


def find_words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, bounds)``: byte ranges of all words, and for text i words ``bounds[i]:bounds[i+1]``."""
    inside = kinds[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    start[cut] = inside[cut]
    end[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offsets)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    power, inverse = _powers(BYTE_BASE, _room(len(data)))
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[e] - sums[s]) * inverse[s])


def windows(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every run of ``k`` words inside one text, and the run's first word."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    power, inverse = _powers(WORD_BASE, _room(n))
    sums = np.zeros(n + 1, U)
    np.cumsum(hashes * power[:n], out=sums[1:])
    ok = np.zeros(n + 1, np.int32)  # runs that stay inside their text start at bounds[i] .. bounds[i+1]-k
    a, b = bounds[:-1], bounds[1:] - k + 1
    full = b > a
    ok[a[full]] += 1
    ok[b[full]] -= 1
    first = np.flatnonzero(np.cumsum(ok[: n - k + 1]) > 0)
    return mix((sums[first + k] - sums[first]) * inverse[first]), first
