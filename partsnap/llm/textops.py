"""Vectorised text helpers for Arrow batches: words, 64-bit word hashes, slices.

Texts stay bytes in one buffer; words are maximal runs of bytes other than
``\\x20\\x09-\\x0D`` (as no byte of a longer UTF-8 sequence is one of these,
that equals the rule on code points).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (in place)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def numbers(seed: int, n: int) -> np.ndarray:
    """n repeatable random 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=U)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts, about ``limit`` bytes each."""
    data, offsets = buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


class Words:
    """Finds and hashes the words of a buffer of texts.

    ``classes`` maps a byte to its class; a word is a maximal run of one class
    other than 0 within one text.  The hash of a word is a polynomial in its
    bytes modulo 2**64 with random byte values, then mixed.
    """

    def __init__(self, classes: np.ndarray | None = None, lower: bool = False):
        if classes is None:
            classes = np.ones(256, np.uint8)
            classes[[9, 10, 11, 12, 13, 32]] = 0
        self.classes = classes
        self.values = numbers(11, 256) | U(1)
        if lower:
            self.values[65:91] = self.values[97:123]
        self.base = U(0x9E3779B97F4A7C15)
        self.inverse = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        self.up = np.cumprod(np.full(n, self.base, U))
        self.down = np.cumprod(np.full(n, self.inverse, U))

    def bounds(self, buf: np.ndarray, offsets: np.ndarray):
        """Starts and ends of all words, and each text's first word (one more at the end)."""
        kind = self.classes[buf]
        edge = np.ones(len(buf) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        if len(starts):
            keep = kind[starts] != 0
            starts, ends = starts[keep], ends[keep]
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, U)
        if len(buf) > len(self.up):
            self.grow(len(buf))
        total = self.values[buf]
        total *= self.up[: len(buf)]
        np.cumsum(total, out=total)
        h = total[ends - 1]
        inner = starts > 0
        h[inner] -= total[starts[inner] - 1]
        h *= self.down[starts]
        h += (ends - starts).astype(U)
        return mix(h)


def runs_min(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, starts)
