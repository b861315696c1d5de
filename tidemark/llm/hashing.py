"""Stateless 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
LOW64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: shift, multiply, shift, multiply, shift."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from the upper 53 bits."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)
