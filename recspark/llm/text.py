"""Whole texts as byte buffers: words, their hashes and n-grams of them, without a Python loop over words.

Every function takes the UTF-8 bytes of an Arrow column and works on slices of
about ``SLICE_BYTES`` and at most ``SLICE_ROWS`` rows, so that memory is bounded by a slice (or by one longer text). Nothing
is copied for more than a slice at a time, and what a batch took is given back to the machine at its end: workers are used again by
the tasks that follow, and would else keep the most that any of them needed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 2048

_BYTE = np.arange(256, dtype=np.uint8)
UPPER = (_BYTE >= 65) & (_BYTE <= 90)
LOWER = (_BYTE >= 97) & (_BYTE <= 122)
DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
#: letters, digits and every byte of a character beyond ASCII
WORD = UPPER | LOWER | DIGIT | (_BYTE >= 128)
FOLD = np.where(UPPER, _BYTE + 32, _BYTE).astype(np.uint8)

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


class Words(NamedTuple):
    """``start`` and ``end`` count bytes of the slice, ``row`` its rows."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(1000 * (seed + 1)))


def _powers(base: int, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006
    """base^0 .. base^(n-1) modulo 2^64; those that a slice needs are kept by the worker."""
    if n > 2 * SLICE_BYTES:
        return _power_row(base, n)
    if base not in kept:
        kept[base] = _power_row(base, 2 * SLICE_BYTES)
    return kept[base][:n]


def _power_row(base: int, n: int) -> np.ndarray:
    row = np.full(n, base, dtype=np.uint64)
    row[:1] = 1
    return np.cumprod(row, out=row)


def give_back() -> None:
    """Return memory that Arrow and the C library hold but do not use to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the rows' offsets in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))


def slices(
    column: pa.Array, size: int = SLICE_BYTES, prepare: Callable[[pa.Array], pa.Array] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with about ``size`` bytes together, each slice ``prepare``d by itself."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    low = 0
    while low < len(column):
        high = max(low + 1, min(low + SLICE_ROWS, int(np.searchsorted(ends, ends[low] + size, side="right")) - 1))
        part = column.slice(low, high - low)
        yield low, *buffers(prepare(part) if prepare else part)
        low = high
    give_back()


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of true bytes; a run never crosses a row."""
    before = np.empty(len(member), bool)
    before[1:] = member[:-1]
    before[:1] = False
    inner = offsets[:-1][offsets[:-1] < len(member)]
    before[inner] = False
    start = np.flatnonzero(member & ~before)
    after = np.empty(len(member), bool)
    after[:-1] = member[1:]
    after[-1:] = False
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    return start, np.flatnonzero(member & ~after) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_codes(seed)[data] * _powers(_ODD, len(data)), out=total[1:])
    value = (total[end] - total[start]) * _powers(_INVERSE, len(data))[start]
    return mix(value + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD, fold: bool = True, seed: int = 0) -> Words:
    """Words of a slice in order; ``fold`` lower-cases A-Z before hashing."""
    start, end = runs(member[data], offsets)
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, end, row, span_hashes(FOLD[data] if fold else data, start, end, seed))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k-1 positions are left out."""
    n = max(0, len(hashes) - k + 1)
    value = np.zeros(n, np.uint64)
    for j in range(k):
        value = value * np.uint64(_ODD) + hashes[j : j + n]
    return mix(value)


def within_row(row: np.ndarray, k: int) -> np.ndarray:
    """Which positions have the k words from there on in one row."""
    n = max(0, len(row) - k + 1)
    return row[:n] == row[k - 1 : k - 1 + n]


def row_counts(row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, minlength=rows).astype(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column of consecutive values."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
