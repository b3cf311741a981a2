"""Exact integer matrix products in float32: residues modulo small primes, put together again.

Every prime is below 1024, so a product of two centred residues is at most 510^2 and the sum of
``CHUNK`` of them stays below 2^24: float32 holds it exactly, in whatever order a matrix product
adds. Longer rows are cut into chunks whose sums are reduced before they are added. The
signed result follows from its residues by Chinese remaindering with centred mixed-radix digits
(Garner), as long as its absolute value is below half the product of the primes.
"""

from __future__ import annotations

import numpy as np

PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)  # their product exceeds 2^69
CHUNK = (1 << 24) // 510**2


def primes_for(bound: float) -> tuple[int, ...]:
    """The fewest primes that tell all whole numbers of at most ``bound`` in absolute value apart."""
    product = 1
    for i, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[: i + 1]
    raise ValueError(f"scores of up to {bound:.3g} do not fit into 64 bits")


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers as their residues of smallest absolute value, in place."""
    np.fmod(x, p, out=x)
    half = p // 2
    x[x > half] -= p
    x[x < -half] += p
    return x


def residues(x: np.ndarray, primes: tuple[int, ...]) -> np.ndarray:
    """Whole numbers (float64, rows x columns) as float32 residues (primes x rows x columns)."""
    out = np.empty((len(primes), *x.shape), np.float32)
    for i, p in enumerate(primes):
        out[i] = _centred(x.copy(), p)
    return out


def product(a: np.ndarray, b: np.ndarray, primes: tuple[int, ...]) -> np.ndarray:
    """``a @ b.T`` as int64 from the residues of ``a`` (m x d) and ``b`` (n x d)."""
    d = a.shape[2]
    digits: list[np.ndarray] = []
    value, weight = None, 1
    for i, p in enumerate(primes):
        total = None
        for c in range(0, max(d, 1), CHUNK):
            part = a[i, :, c : c + CHUNK] @ b[i, :, c : c + CHUNK].T
            part = np.fmod(part, np.float32(p), out=part)
            total = part if total is None else np.add(total, part, out=total)
        rest = total.astype(np.int64)
        # the digits found so far, modulo p, and this prime's digit
        step = 1
        for q, digit in zip(primes, digits):
            rest -= digit * step
            step = step * q % p
        if digits:
            rest %= p
            rest *= pow(step, -1, p)
        digit = _centred(rest, p)
        # the value is summed modulo 2^64, where it fits in the end
        part = digit * np.int64(weight - (1 << 64) if weight >= 1 << 63 else weight)
        value = part if value is None else np.add(value, part, out=value)
        digits.append(digit)
        weight = weight * p % (1 << 64)
    return value
