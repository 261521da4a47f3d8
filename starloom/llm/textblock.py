"""Words of whole text columns as numpy arrays.

A word is a maximal run of bytes other than ``0x20`` and ``0x09-0x0D``, with
``A-Z`` lower-cased; that is the class ``[^\\x20\\x09-\\x0D]+`` of characters,
as every byte of a longer UTF-8 character is above ``0x7F``. A word is known by
a 64-bit polynomial hash, so no Python string is made for it. Work goes through
slices of about ``SLICE_BYTES`` bytes of text (or one text, if that is longer),
which bounds the memory of a task whatever the batch size is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 (wrap-around products)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = mix(_LOWER.astype(_U) + _U(0x51ED27))
_VALUE[_SPACE] = 0
_RAW_VALUE = mix(np.arange(256, dtype=_U) + _U(0x51ED27))
_RAW_VALUE[_SPACE] = 0

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        have = np.full(size, base, _U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:  # what a very long text needs is not kept
            _powers[base] = have
    return have[:n]


def release_memory() -> None:
    """Give freed memory back, so that a worker holds only what its present task needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """The words of ``rows`` texts: ``row`` (of the slice), ``start`` and ``end`` byte, ``hash``."""

    first_row: int
    rows: int
    data: np.ndarray
    bounds: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.row, minlength=self.rows)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def slices(column: pa.Array, *, lower: bool = True) -> Iterator[Words]:
    """The words of a string column, in slices of whole texts."""
    data, bounds = _buffers(column)
    n, first = len(bounds) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SLICE_BYTES, "right")) - 1)
        last = min(last, n)
        part = data[bounds[first]:bounds[last]]
        yield _words(first, part, bounds[first:last + 1] - bounds[first], lower)
        first = last


def _words(first: int, data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    rows = len(bounds) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(first, rows, data, bounds, none, none, none, np.zeros(0, _U))
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    cut = bounds[1:] - 1
    after[cut[cut >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    if len(start):
        value = (_VALUE if lower else _RAW_VALUE)[data]
        value *= powers(_BASE, len(data))
        h = np.add.reduceat(value, start) * powers(_BASE_INV, len(data))[start]
        h = mix(h + (end - start).astype(_U))
    else:
        h = np.zeros(0, _U)
    row = np.searchsorted(bounds, start, "right") - 1
    return Words(first, rows, data, bounds, row, start, end, h)


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct ``size``-word shingles of each text, ordered by row, then hash.

    A text with fewer words than that has its whole sequence as its only
    shingle; one without words has none.
    """
    n = len(words.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    counts = words.counts
    length = np.minimum(counts, size)
    shingles = np.where(counts > 0, counts - length + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    row = np.repeat(np.arange(words.rows), shingles)
    done = np.concatenate([[0], np.cumsum(shingles)])
    at = np.arange(done[-1]) + np.repeat(first - done[:-1], shingles)
    padded = np.concatenate([words.hash, np.zeros(size, _U)])
    h = np.zeros(len(at), _U)
    short = np.flatnonzero((counts > 0) & (counts < size))
    for k in range(size):
        h *= _U(0xD6E8FEB86659FD93)
        h += padded[k:][at]
    for r in short:  # the whole sequence, told apart by its length
        h[done[r]] = np.add.reduce(words.hash[first[r]:first[r] + counts[r]]
                                   * powers(0xD6E8FEB86659FD93, size)[:counts[r]]) + _U(counts[r])
    h = mix(h)
    for a, b in zip(done[:-1].tolist(), done[1:].tolist()):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[keep], h[keep]
