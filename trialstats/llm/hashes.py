"""Sorted hash arrays: lookups in large tables of 64-bit hashes, and their packed form in rows."""

from __future__ import annotations

import tempfile

import numpy as np
from zstandard import ZstdCompressor, ZstdDecompressor

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray, sort_gaps: bool = False) -> bytes:
    """Numbers as compressed bytes, equal places side by side; sorted ones as gaps."""
    if sort_gaps and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    width = values.dtype.itemsize
    return ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T))


def unpack(data: bytes, dtype: str, sort_gaps: bool = False) -> np.ndarray:
    """The inverse of ``pack``."""
    kind = np.dtype(dtype)
    raw = np.frombuffer(ZstdDecompressor().decompress(data), np.uint8).reshape(kind.itemsize, -1)
    values = np.ascontiguousarray(raw.T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if sort_gaps else values


class SortedHashes:
    """Sorted distinct hashes with a table of where each leading pattern of bits begins."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(1, len(keys).bit_length())
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.starts = np.append(np.searchsorted(keys, edges), len(keys))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of hashes, -1 for those that aren't there."""
        lead = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        out = np.full(len(wanted), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            hit = self.keys[at] == wanted[left]
            out[left[hit]] = at[hit]
            at += 1
            more = ~hit & (at < end)
            left, at, end = left[more], at[more], end[more]
        return out


def mapped(values: np.ndarray) -> np.ndarray:
    """The array as a memory map of a file without a name: its pages can leave memory, and nothing is left behind."""
    if not len(values):
        return values
    with tempfile.TemporaryFile() as f:
        values.tofile(f)
        f.flush()
        return np.memmap(f, values.dtype, "r", shape=values.shape)


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d3 = 3 - 4 * y * n4 / n3 if n3 else 3 * y
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, d3]
    return np.array([0.0, *(min(max(d[k], 0.05), k - 0.05) for k in (1, 2, 3))])
