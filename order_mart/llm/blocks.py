"""Vectorised byte, word, line and shingle hashing over Arrow text columns.

Hashes are 64-bit polynomials over a table of random byte values, computed for
any substring from one running sum, then mixed.  All functions take the
concatenated bytes of a slice of rows and the rows' offsets.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 - 2)          # 3 modulo 8: both base-1 and base+1 hold few factors of two
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_M1, _M2, _M3 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x2545F4914F6CDD1D)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Continuation bytes of UTF-8; every other byte starts a code point.
FOLLOWS = np.zeros(256, bool)
FOLLOWS[0x80:0xC0] = True


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = _U(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _M1
    h = (h ^ (h >> _U(27))) * _M2
    return h ^ (h >> _U(31))


class Rolling:
    """Hashes of any substrings of ``data``: equal bytes give equal hashes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(10, int(len(data)).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _M3)

    def windows(self, width: int) -> np.ndarray:
        """Hash of every substring of ``width`` bytes, by its start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def pieces(is_break: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, rows) of the maximal runs without a break, cut at rows."""
    if not len(is_break):
        return (np.zeros(0, np.int64),) * 3
    inside = ~is_break
    first = np.zeros(len(inside) + 1, bool)
    first[offsets] = True
    begin = inside.copy()
    begin[1:] &= is_break[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= is_break[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word ``[^\x20\x09-\x0D]+`` in order."""
    starts, ends, rows = pieces(SPACE[data], offsets)
    return Rolling(data).of(starts, ends), rows


def windows_of(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first index) of every run of ``width`` words within a row."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(n, _U(width) * _M3)
    for i in range(width):
        h = mix(h + hashes[i: i + n]) * _M2
    at = np.flatnonzero(rows[:n] == rows[width - 1:])
    return mix(h[at]), at


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each row's entries in an array sorted by row."""
    return np.searchsorted(rows, np.arange(n + 1))
