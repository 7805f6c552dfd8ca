"""Texts as numpy arrays: words, rolling hashes, window minima.

Hashes are polynomials over 64-bit arithmetic with a random value per byte and
an odd base, finished by a mixing step.  All functions work on many texts at
once; nothing loops over characters or words in Python.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Window minima are taken over tiles of this many positions; 24 bits hold a position in a tile.
TILE = 1 << 16
#: Powers kept in memory, 8 MB for each base.
KEPT_POWERS = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h *= U(0x7FB5D329728EA185)
    h ^= h >> U(27)
    h *= U(0x81DADEF4BC2DD44D)
    h ^= h >> U(33)
    return h


def _power_arrays(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    b = _BASES[base]
    out = []
    for factor in (b, pow(b, -1, 1 << 64)):
        p = np.full(n, factor, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_kept_powers = lru_cache(maxsize=3)(lambda base: _power_arrays(KEPT_POWERS, base))


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse; only short ones are kept."""
    if n > KEPT_POWERS:
        return _power_arrays(n, base)
    p, q = _kept_powers(base)
    return p[:n], q[:n]


def prefix(values: np.ndarray, base: int = 0) -> np.ndarray:
    """Sums such that ``span`` gives the polynomial of any range."""
    p, _ = powers(len(values), base)
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * p, dtype=U, out=out[1:])
    return out


def span(sums: np.ndarray, a: np.ndarray, b: np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the ranges [a, b)."""
    _, q = powers(len(sums), base)
    return mix((sums[b] - sums[a]) * q[a])


def rolling(values: np.ndarray, length: int, base: int = 0) -> np.ndarray:
    """Hashes of all windows of ``length`` values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    sums = prefix(values, base)
    _, q = powers(n, base)
    return mix((sums[length:] - sums[:-length]) * q)


def window_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost minimum of each window of ``w`` hashes, by their upper 40 bits."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    low = U((1 << 24) - 1)
    place = np.arange(TILE + w, dtype=U)
    for a in range(0, n, TILE):
        part = h[a : min(a + TILE, n) + w - 1]
        m = (part & ~low) | place[: len(part)]
        size = 1
        while size * 2 <= w:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < w:
            m = np.minimum(m[: len(m) - (w - size)], m[w - size :])
        out[a : a + len(m)] = (m & low).astype(np.int64) + a
    return out


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as UTF-8, each followed by one space, and where each starts (one more entry at the end)."""
    raw = [(t or "").encode() for t in texts]
    x = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    return x, starts


class Words:
    """The words of many texts: ``hash`` per word, byte range ``start``/``end``, and ``first`` word of each text."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        x, self.byte_start = joined(texts)
        if lower:
            x = LOWER[x]
        self.bytes = x
        gap = np.ones(len(x) + 1, bool)
        gap[1:] = SPACE[x]
        self.start = np.flatnonzero(gap[:-1] & ~gap[1:])
        self.end = np.flatnonzero(~gap[:-1] & gap[1:])
        self.hash = span(prefix(BYTE_VALUES[x]), self.start, self.end)
        self.first = np.searchsorted(self.start, self.byte_start)
        self.count = np.diff(self.first)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start (word index) of each window of ``length`` words inside one text, and the text's index."""
        n = np.maximum(self.count - length + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return self.first[:-1][text] + at, text


def ranges(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [a, b) of consecutive integers in a sorted array."""
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    a = at[np.concatenate([[0], cut])]
    b = at[np.concatenate([cut - 1, [len(at) - 1]])] + 1
    return a, b


def expand(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All integers of the runs [a, b), in order."""
    n = b - a
    return np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
