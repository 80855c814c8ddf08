"""Vectorised word splitting and hashing over Arrow string buffers.

Words are ``[^\\x20\\x09-\\x0D]+``.  Every separator is a single ASCII byte, so
splitting the UTF-8 bytes is exact and no text is decoded.  All functions work
on one Arrow batch at a time inside a Spark task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x += _C1
    x ^= x >> np.uint64(30)
    x *= _C2
    x ^= x >> np.uint64(27)
    x *= _C3
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, raw_offsets, data = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return buf, offsets - offsets[0]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; no other byte changes."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[buf]


def split_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the word offsets of each row."""
    if not len(buf):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = (buf == 32) | ((buf - np.uint8(9)) <= 4)
    word = ~space
    first, last = word.copy(), word.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    edge = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[edge] = word[edge]
    edge = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[edge] = word[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit content hash of byte spans, eight bytes a step for all spans at once."""
    size = (ends - starts).astype(np.int64)
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    eight = np.ndarray((len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix64(size.astype(np.uint64) ^ np.uint64(seed))
    if not len(size):
        return h
    keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
    live, step = np.arange(len(size)), 0
    while len(live):
        left = size[live] - step
        part = eight[starts[live] + step] & keep[np.minimum(left, 8)]
        if len(live) == len(h):
            h = mix64(h ^ part)
        else:
            h[live] = mix64(h[live] ^ part)
        step += 8
        live = live[left > 8]
    return h


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class PrefixHash:
    """Hashes of any slice of a 64-bit sequence from one cumulative sum."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, values: np.ndarray):
        n = len(values)
        inverse = pow(self.BASE, -1, 1 << 64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n, self.BASE), out=self.sums[1:])
        self.back = powers(n + 1, inverse)

    def slices(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def row_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20):
    """Row slices of a batch holding about ``max_bytes`` of text, one row at least.

    Whole rows only: a longer text is a slice of its own, never cut.
    """
    sizes = np.asarray(pa.compute.binary_length(batch.column(column).cast(pa.large_string())).fill_null(0))
    group = np.cumsum(sizes) // max_bytes
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)
