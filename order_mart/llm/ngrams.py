"""Hashed character n-grams of UTF-8 text, vectorised over a slice of rows."""

from __future__ import annotations

import numpy as np

from .blocks import LOWER, SPACE, Rolling


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals lower-cased and ASCII white
    space as plain spaces."""
    out = LOWER[data]
    out[SPACE[out]] = 0x20
    if len(out) > 1:
        second = out[1:]
        capital = (out[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[capital] += 0x20
    return out


def buckets(data: np.ndarray, offsets: np.ndarray, widths: tuple[int, ...], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each width: the bucket of the n-gram at every position, and whether
    the n-gram lies within its row."""
    rolling = Rolling(data)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    out = []
    for width in widths:
        hashes = rolling.windows(width)
        out.append(((hashes >> np.uint64(64 - bits)).astype(np.int64), np.arange(len(hashes)) + width <= ends[: len(hashes)]))
    return out


def counts(data: np.ndarray, offsets: np.ndarray, widths: tuple[int, ...], bits: int) -> np.ndarray:
    """Matrix of n-gram counts: rows by buckets."""
    n, size = len(offsets) - 1, 1 << bits
    rows = np.repeat(np.arange(n), np.diff(offsets))
    total = np.zeros(n * size, np.int64)
    for at, inside in buckets(data, offsets, widths, bits):
        total += np.bincount((rows[: len(at)] * size + at)[inside], minlength=n * size)
    return total.reshape(n, size)


def present(data: np.ndarray, offsets: np.ndarray, widths: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """Distinct buckets of each row."""
    made, last = buckets(data, offsets, widths, bits), np.zeros(1 << bits, np.int32)
    out = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = [at[start: max(start, end - width + 1)] for width, (at, _) in zip(widths, made, strict=True)]
        own = np.concatenate(own) if own else np.zeros(0, np.int64)
        order = np.arange(len(own), dtype=np.int32)
        last[own] = order
        out.append(own[last[own] == order])
    return out
