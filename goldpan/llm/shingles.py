"""Words and word shingles of whole texts as 64-bit values, computed on byte arrays."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE[_BLANK] = 0
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.cumprod(factors)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(data: bytes) -> np.ndarray:
    """One value per word, in order. Words are runs of bytes other than ASCII white space, A-Z lower-cased."""
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    if not len(raw):
        return np.empty(0, np.uint64)
    solid = ~_BLANK[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.add.reduceat(_BYTE[raw] * _powers(_STEP, len(raw)), starts)
    return mix(sums * _powers(_BACK, len(raw))[starts])


def shingles(data: bytes, size: int) -> np.ndarray:
    """The sorted set of ``size``-word shingles; a text of fewer words is one shingle, one without words has none."""
    w = words(data)
    if not len(w):
        return w
    width = min(size, len(w))
    total = np.full(len(w) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * np.uint64(_STEP) + w[k : k + len(total)]
    return np.unique(mix(total))
