"""Vectorised access to Arrow text columns: bytes, words and rolling hashes of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step works on; longer single texts are a step of their own.
STEP = 4 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, size: int = STEP):
    """Row ranges of about ``size`` bytes each; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(rows, max(start + 1, stop))
        yield start, stop
        start = stop


def is_white() -> np.ndarray:
    """Per byte value: true for the blank and for 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray, white: np.ndarray):
    """Start and end of every word and the row it stands in. Words never cross rows."""
    solid = ~white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = True, ~solid[:-1]
        after[-1], after[:-1] = True, ~solid[1:]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


class Rolling:
    """Hashes of byte ranges in constant time from prefix sums modulo 2**64.

    A pure function of the bytes in the range: equal strings have equal hashes anywhere.
    """

    def __init__(self):
        bits = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        bits ^= bits >> np.uint64(29)
        self.value = bits * np.uint64(0xBF58476D1CE4E5B9)
        self.power = self.inverse = np.ones(1, np.uint64)

    def reserve(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * len(self.power))
            for name, factor in (("power", BASE), ("inverse", INVERSE)):
                table = np.full(n, factor)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self.reserve(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:len(data)], out=sums[1:])
        return sums

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((prefix[ends] - prefix[starts]) * self.inverse[starts]
                   + (ends - starts).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, so that any of them can pick a bucket."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
