"""Compact n-gram levels: Elias-Fano sequences and a two-level trie over them, memory-mapped."""

from __future__ import annotations

import os
import tempfile

import numpy as np

_U = np.uint64
_ONE = _U(1)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the ``k``-th (from 0) set bit of each word, halving the part that holds it."""
    k = k.astype(np.int64)
    at = np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count((word >> at.astype(_U)) & _U((1 << width) - 1)).astype(np.int64)
        up = k >= low
        k -= np.where(up, low, 0)
        at += np.where(up, width, 0)
    return at


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts as gaps in unary."""

    def __init__(self, values: np.ndarray):
        values = values.astype(_U)
        n = len(values)
        top = int(values[-1]) if n else 0
        self.n = n
        self.width = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> _U(self.width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(high[-1]) if n else 0) // 64 + 1) * 64, np.uint8)
        bits[high] = 1
        self.high = np.packbits(bits, bitorder="little").view(_U)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high).astype(np.int64))]).astype(np.uint32)
        self.low = np.zeros((n * self.width) // 64 + 2, _U)
        if self.width:
            low = values & _U((1 << self.width) - 1)
            at = np.arange(n, dtype=np.int64) * self.width
            word, shift = at >> 6, (at & 63).astype(_U)
            np.bitwise_or.at(self.low, word, low << shift)
            over = (at & 63) + self.width > 64
            np.bitwise_or.at(self.low, word[over] + 1, low[over] >> (_U(64) - shift[over]))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        word = np.searchsorted(self.before, i.astype(np.uint32), "right") - 1
        place = _select_in_word(self.high[word], i - self.before[word].astype(np.int64))
        value = (word * 64 + place - i).astype(_U) << _U(self.width)
        if self.width:
            at = i.astype(np.int64) * self.width
            word, shift = at >> 6, (at & 63).astype(_U)
            low = self.low[word] >> shift
            over = (at & 63) + self.width > 64
            low[over] |= self.low[word[over] + 1] << (_U(64) - shift[over])
            value |= low & _U((1 << self.width) - 1)
        return value.astype(np.int64)

    @property
    def arrays(self) -> list[str]:
        return ["high", "before", "low"]


def memory_map(owner: object, names: list[str]) -> None:
    """Put arrays of an object in a file that is mapped and already unlinked, so nothing is left behind."""
    fd, path = tempfile.mkstemp(prefix="ngram-level-")
    try:
        with os.fdopen(fd, "wb") as f:
            places = []
            for name in names:
                a = np.ascontiguousarray(getattr(owner, name))
                f.write(b"\0" * (-f.tell() % 8))
                places.append((name, f.tell(), a.dtype, a.shape))
                f.write(a.tobytes())
        for name, at, dtype, shape in places:
            if shape[0]:
                setattr(owner, name, np.memmap(path, dtype, "r", at, shape))
    finally:
        os.unlink(path)


class Quantiser:
    """Log10 probabilities in 16-bit codes, rounded down."""

    STEP = 1 / 3000

    @classmethod
    def codes(cls, logs: np.ndarray) -> np.ndarray:
        return np.minimum(np.ceil(-logs / cls.STEP - 1e-9), 65535).astype(np.uint16)

    @classmethod
    def logs(cls, codes: np.ndarray) -> np.ndarray:
        return codes * -cls.STEP


class BigramTrie:
    """Contexts, monotone pointers to their successors, and the successors with their codes.

    ``context`` and ``follower`` are ids below ``words``, sorted by context,
    then follower; ``logs`` is of each pair. A successor is kept as its id plus
    the last value of the context before, so the whole level does not decrease;
    what is searched is relative to the context.
    """

    def __init__(self, context: np.ndarray, follower: np.ndarray, logs: np.ndarray):
        ids, first = np.unique(context, return_index=True)
        first = np.append(first, len(context))
        self.contexts = EliasFano(ids)
        self.pointers = EliasFano(first)
        self.ids = ids.astype(np.uint32)
        last = follower[first[1:] - 1] if len(ids) else np.zeros(0, np.int64)
        base = np.concatenate([[0], np.cumsum(last)])
        self.bases = EliasFano(base)
        self.followers = EliasFano(follower + np.repeat(base[:-1], np.diff(first)))
        self.codes = Quantiser.codes(logs)
        for level in (self.contexts, self.pointers, self.bases, self.followers):
            memory_map(level, level.arrays)
        memory_map(self, ["codes"])

    def find(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(whether the pair is there, its log10 probability)``."""
        n = len(self.ids)
        found, logs = np.zeros(len(context), bool), np.zeros(len(context))
        if not n:
            return found, logs
        at = np.minimum(np.searchsorted(self.ids, context.astype(np.uint32)), n - 1)
        rows = np.flatnonzero(self.contexts.get(at) == context)
        at = at[rows]
        low, high = self.pointers.get(at), self.pointers.get(at + 1)
        target = follower[rows] + self.bases.get(at)
        value = np.full(len(rows), -1)
        open_ = np.arange(len(rows))
        # the successor: first place in the context's range that is not smaller
        end = high.copy()
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            got = self.followers.get(mid)
            less = got < target[open_]
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
            value[open_] = np.where(less, value[open_], got)
            open_ = open_[low[open_] < high[open_]]
        hit = (low < end) & (value == target)
        found[rows[hit]] = True
        logs[rows[hit]] = Quantiser.logs(self.codes[low[hit]].astype(np.float64))
        return found, logs
