"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

An item occurs in a text if some stretch of the text's words is within
``len(item) // 4`` word edits of the item's words (similarity 0.75 or more);
an item of one to four words only if all of the text's words are.
Words are compared by hash, ``A-Z`` lower-cased.

* *Embedding.* A random walk over a window emits, at each step, the word it
  stands on, and goes on to the next word or stays, by a bit that the word and
  the step decide. Two windows a few edits apart fall back into step, so their
  emitted words agree at most steps: edit distance becomes Hamming distance.
* *Bit sampling.* Each repetition takes ``SAMPLED`` steps and hashes the words
  emitted there; windows that agree on one repetition are candidates. With
  ``REPETITIONS`` over ``WALKS`` independent walks, the recall of items with up
  to a quarter of their words replaced, spread out or bunched anywhere, is above
  0.9 (measured in the tests); unchanged items are always found, as some window
  of the text begins on one of the first ``STRIDE`` windows of each item.
* *Windows* are of the largest size in ``WINDOW_SIZES`` that fits the item
  twice, up to 64 words. They are indexed over the whole item, ``STRIDE`` of them
  at every half window and at its end, as a walk gets through about half of its
  window: wherever the edits are, some walks meet no more than their share of
  them. What is verified is the whole item.
* *Short items*, which no window fits twice, are sought exactly: cut into one
  part more than the edits allowed, one part at least is in the text unchanged,
  and each part is looked up at every word. Items under ``SHORTEST`` words are
  too common within texts; they match a text that is, as a whole, within a
  quarter of their words.

The benchmark is indexed in blocks of a bounded size, each broadcast to one pass
over whole texts; a pass needs no shuffle. The benchmark is a stated query set,
so passes grow with it, not with the corpus.

Defined results: null or empty texts and items match nothing; equal items each
match; one row for each text and item, its closest and then first place.
Repeated rows each get their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.textblock import Words, mix, slices

STRIDE = 5
WINDOW_SIZES = (8, 12, 18, 27, 40, 64)
SAMPLED = 3
REPETITIONS = 12
WALKS = 2
SHORTEST = 5
BLOCK_BYTES = 16 << 20
#: Candidates of a slice that are held before those that cannot match are dropped.
HELD_CANDIDATES = 1 << 18

_U = np.uint64
_FACTORS = [_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)]
_rng = np.random.default_rng(17)
#: Steps of each repetition: ``[size][repetition]``; repetition ``r`` follows walk ``r % WALKS``.
STEPS = {w: [sorted(_rng.choice(w, SAMPLED, replace=False).tolist()) for _ in range(REPETITIONS)] for w in WINDOW_SIZES}


def window_size(words: int) -> int | None:
    """The window of an item of so many words, None if it is looked for by its parts."""
    fits = [w for w in WINDOW_SIZES if 2 * w + STRIDE - 1 <= words]
    return fits[-1] if fits else None


def window_starts(words: int, size: int) -> np.ndarray:
    """The first words of the windows that are indexed of an item of so many words."""
    last = words - size - STRIDE + 1
    return np.unique(np.append(np.arange(0, last, size // 2), last)[:, None] + np.arange(STRIDE))


def most_edits(words: int) -> int:
    return words // 4


def part_bounds(words: int) -> list[tuple[int, int]]:
    """One part more than edits allowed, as even as can be: one of them at least is met by no edit."""
    cut = np.arange(most_edits(words) + 2) * words // (most_edits(words) + 1)
    return list(zip(cut[:-1].tolist(), cut[1:].tolist()))


def window_keys(words: np.ndarray, starts: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(size, repetition, key of each start)``. A walk of ``size`` steps stays within ``size`` words."""
    longest = max(sizes)
    padded = np.concatenate([words, np.zeros(longest + 1, _U)])
    for walk in range(WALKS):
        turns: dict[int, list[tuple[int, int, int]]] = {}
        for size in sizes:
            for rep in range(walk, REPETITIONS, WALKS):
                for k, step in enumerate(STEPS[size][rep]):
                    turns.setdefault(step, []).append((size, rep, k))
        keys: dict[tuple[int, int], np.ndarray] = {}
        at, bits = starts.copy(), None
        for step in range(max(turns) + 1):
            if step in turns:
                symbol = padded[at]
                for size, rep, k in turns[step]:
                    part = symbol * _FACTORS[k]
                    if k:
                        keys[size, rep] += part
                    else:
                        keys[size, rep] = part
                    if k == SAMPLED - 1:
                        yield size, rep, keys.pop((size, rep))
            if bits is None or step % 64 == 0:
                bits = mix(padded ^ _U(0x1000193 * (1 + walk) + (step // 64) * 0x3779))
            at += ((bits[at] >> _U(step % 64)) & _U(1)).astype(np.int64)


@dataclass
class Table:
    """Keys of one window size and repetition, behind a table of the top bits that occur."""

    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    shift: np.uint64 = field(init=False)
    seen: np.ndarray = field(init=False)

    def __post_init__(self):
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.item, self.offset = self.keys[order], self.item[order], self.offset[order]
        bits = min(26, max(12, int(len(order)).bit_length() + 8))
        self.shift = _U(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.keys >> self.shift] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(position in keys, item, offset)`` of all matches."""
        at = np.flatnonzero(self.seen[keys >> self.shift])
        low, high = np.searchsorted(self.keys, keys[at], "left"), np.searchsorted(self.keys, keys[at], "right")
        n = high - low
        at, row = np.repeat(at, n), np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return at, self.item[row], self.offset[row]


class Index:
    """A block of benchmark items."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.words = [], []
        found: list[np.ndarray] = []
        for w in slices(pa.array(texts, pa.string())):
            cut = np.concatenate([[0], np.cumsum(w.counts)])
            found += [w.hash[a:b] for a, b in zip(cut[:-1], cut[1:])]
        parts: dict[tuple[int, int], list] = {}
        short: tuple[dict[int, list], dict[int, list]] = {}, {}     # sought in texts, sought as texts
        for item_id, words in zip(ids, found):
            if not len(words):
                continue
            k = len(self.ids)
            self.ids.append(item_id)
            self.words.append(words)
            size = window_size(len(words))
            if size is None:
                for a, b in part_bounds(len(words)):
                    short[len(words) < SHORTEST].setdefault(b - a, []).append((int(_whole(words[a:b], b - a)[0]), k, a))
                continue
            starts = window_starts(len(words), size)
            item, offset = np.full(len(starts), k, np.int32), starts.astype(np.int32)
            for size, rep, keys in window_keys(words, starts, [size]):
                parts.setdefault((size, rep), []).append((keys, item, offset))
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, _U), *self.words]))
        self.numbers = [np.searchsorted(self.vocabulary, words) for words in self.words]
        bits = min(24, len(self.vocabulary).bit_length() + 6)
        self.shift, self.seen = _U(64 - bits), np.zeros(1 << bits, bool)
        self.seen[self.vocabulary >> self.shift] = True
        self.tables = {at: Table(*(np.concatenate(c) for c in zip(*rows))) for at, rows in parts.items()}
        self.sizes = sorted({size for size, _ in self.tables})
        self.within, self.alone = ({n: Table(*(np.array(c, t) for c, t in zip(zip(*rows), (_U, np.int32, np.int32))))
                                    for n, rows in parts_of.items()} for parts_of in short)

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's place in the items' vocabulary, its length for a word that no item has."""
        out = np.full(len(hashes), len(self.vocabulary))
        at = np.flatnonzero(self.seen[hashes >> self.shift])
        place = np.searchsorted(self.vocabulary, hashes[at])
        place[place == len(self.vocabulary)] = 0
        known = self.vocabulary[place] == hashes[at] if len(self.vocabulary) else np.zeros(0, bool)
        out[at[known]] = place[known]
        return out

    def candidates(self, w: Words, numbers: np.ndarray) -> np.ndarray:
        """Rows ``(text, first word of the item, item)``, distinct, and ordered by item, text and place."""
        counts = w.counts
        first = np.cumsum(counts) - counts
        end = first + counts
        found, held = [], []

        def hold(rows: np.ndarray | None) -> None:
            """Candidates of several tables are told apart together; what is held is bounded."""
            if rows is not None and len(rows):
                held.append(rows)
            if held and (rows is None or sum(map(len, held)) > HELD_CANDIDATES):
                found.append(self._plausible(numbers, np.concatenate(held)))
                held.clear()

        if self.sizes:
            n = -(-counts // STRIDE)
            row = np.repeat(np.arange(w.rows), n)
            starts = first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
            room = end[row] - starts
            good = room >= self.sizes[0]
            starts, row, room = starts[good], row[good], room[good]
            if len(starts):
                for size, rep, keys in window_keys(w.hash, starts, self.sizes):
                    at, item, offset = self.tables[size, rep].find(keys)
                    ok = room[at] >= size
                    hold(np.stack([row[at], starts[at] - offset, item], 1)[ok])
        for n, known in self.within.items():
            if len(w.hash) >= n:
                at, item, offset = known.find(_whole(w.hash, n))
                ok = w.row[at] == w.row[at + n - 1]
                hold(np.stack([w.row[at], at - offset, item], 1)[ok])
        hold(None)
        if self.alone:
            few = np.flatnonzero(counts[w.row] < SHORTEST - 1 + most_edits(SHORTEST - 1) + 1)
            for n, known in self.alone.items():
                if len(few) >= n:
                    at, item, _ = known.find(_whole(w.hash[few], n))
                    ok = w.row[few[at]] == w.row[few[at + n - 1]]
                    row = w.row[few[at]]
                    found.append(np.stack([row, first[row], item], 1)[ok])
        found = [f for f in found if len(f)]
        return _distinct(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)

    def _plausible(self, numbers: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Distinct candidates around which enough words are words of the item: all but ``most_edits`` must be."""
        found = _distinct(found)
        keep = np.zeros(len(found), bool)
        marked = np.zeros(len(self.vocabulary) + 1, np.uint8)
        cut = np.flatnonzero(np.diff(found[:, 2], prepend=-1, append=-1))
        for a, b in zip(cut[:-1], cut[1:]):
            item = self.numbers[found[a, 2]]
            most = most_edits(len(item))
            marked[item] = 1
            # words of the item up to each place of the stretch that its candidates touch
            low, high = max(0, int(found[a:b, 1].min()) - most), int(found[a:b, 1].max()) + len(item) + most
            if high - low <= (b - a) * (len(item) + 2 * most):
                sums = np.concatenate([[0], np.cumsum(marked[numbers[low:high]], dtype=np.int64)])
                ends = [np.clip(found[a:b, 1] + d - low, 0, len(sums) - 1) for d in (-most, len(item) + most)]
                near = sums[ends[1]] - sums[ends[0]]
            else:
                at = found[a:b, 1][:, None] + np.arange(-most, len(item) + most)
                near = (marked[numbers[np.clip(at, 0, len(numbers) - 1)]] * ((at >= 0) & (at < len(numbers)))).sum(1)
            keep[a:b] = near >= len(item) - most
            marked[item] = 0
        return found[keep]

    def matches(self, w: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, item id, first byte, end byte, edits)``: the closest place of each item in each text."""
        counts = w.counts
        first = np.cumsum(counts) - counts
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        numbers = self.numbered(w.hash)
        marked = np.zeros(len(self.vocabulary) + 1, bool)
        for row, begin, item in self.candidates(w, numbers).tolist():
            words = self.words[item]
            most = most_edits(len(words))
            known = best.get((row, item))
            if known is not None and known[0] == 0:
                continue
            a = max(begin - most, int(first[row]))
            b = min(begin + len(words) + most, int(first[row] + counts[row]))
            if len(words) < SHORTEST:
                edits = word_edits(words.tolist(), w.hash[first[row]:first[row] + counts[row]].tolist())
                got = (edits, 0, int(counts[row])) if edits <= most else None
            else:
                marked[numbers[a:b]] = True
                shared = int(marked[self.numbers[item]].sum())
                marked[numbers[a:b]] = False
                got = closest(words, w.hash[a:b], most, begin - a) if shared >= len(words) - most else None
            if got is not None and (known is None or (got[0], a + got[1]) < known[:2]):
                best[row, item] = (got[0], a + got[1], a + got[2])
        for (row, item), (edits, a, b) in sorted(best.items()):
            yield row, self.ids[item], int(w.start[a] - w.bounds[row]), int(w.end[b - 1] - w.bounds[row]), edits


def _distinct(found: np.ndarray) -> np.ndarray:
    """Distinct rows ``(text, place, item)``, ordered by item, text and place."""
    low = found.min(0)
    texts, places, items = (int(n) for n in found.max(0) - low + 1)
    if texts * places * items >= 1 << 62:
        return np.unique(found[:, [2, 0, 1]], axis=0)[:, [1, 2, 0]]
    text, place, item = (found - low).T
    keys = np.unique((item * texts + text) * places + place)
    return np.stack([keys // places % texts, keys % places, keys // (texts * places)], 1) + low


def _whole(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words."""
    h = np.zeros(len(words) - n + 1, _U)
    for k in range(n):
        h = h * _FACTORS[0] + words[k:len(words) - n + 1 + k]
    return mix(h)


def word_edits(item: list[int], text: list[int]) -> int:
    """The word edits that turn the item into the whole text; both are short."""
    row = list(range(len(text) + 1))
    for k, word in enumerate(item, 1):
        new = [k]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def closest(item: np.ndarray, text: np.ndarray, most: int, guess: int) -> tuple[int, int, int] | None:
    """``(edits, begin, end)`` of the stretch of ``text`` nearest to ``item``, if within ``most`` word edits.

    The first such stretch by its end. Exact: a column of the edit distance
    table for each word of the item, free to begin anywhere in the text.
    """
    if 0 <= guess and guess + len(item) <= len(text) and np.array_equal(text[guess:guess + len(item)], item):
        return 0, guess, guess + len(item)
    if not most or not len(text):
        return None
    n = len(text)
    place = np.arange(n + 1)
    cost, begin = np.zeros(n + 1, np.int64), place.copy()
    for k, word in enumerate(item.tolist()):
        kept = cost[:-1] + (text != _U(word))
        gone = cost + 1
        new, came = gone.copy(), begin.copy()
        better = kept < new[1:]
        new[1:][better] = kept[better]
        came[1:][better] = begin[:-1][better]
        # words of the text that the item lacks: the best of all columns to the left
        slope = new - place
        low = np.minimum.accumulate(slope)
        fresh = slope == low
        last = np.maximum.accumulate(np.where(fresh, place, 0))
        cost, begin = low + place, came[last]
    end = int(cost.argmin())
    return (int(cost[end]), int(begin[end]), end) if cost[end] <= most and begin[end] < end else None


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks of about ``BLOCK_BYTES`` of text."""
    rows = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
            .where(F.col("item_id").isNotNull() & F.col("text").isNotNull()))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).distinct().orderBy("item_id", "text").toArrow()
        yield Index(part["item_id"].to_pylist(), part["text"].to_pylist())


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``start`` and ``end`` byte and word ``edits`` of each item in each text."""
    schema = "doc_id long, item_id long, start long, end long, edits int"
    sc, rows = docs.sparkSession.sparkContext, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark):
        shared = sc.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(w.first_row + m[0], *m[1:]) for w in slices(batch.column("text")) for m in shared.value.matches(w)]
                if found:
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(cols[0], pa.int64())),
                         *(pa.array(c, pa.int64()) for c in cols[1:4]), pa.array(cols[4], pa.int32())],
                        ["doc_id", "item_id", "start", "end", "edits"])

        out = out.union(rows.mapInArrow(run, schema))
    return out


def _holds(shared) -> Callable[[Column], Column]:
    @F.arrow_udf("boolean")
    def run(text: pa.Array) -> pa.Array:
        found = np.zeros(len(text), bool)
        for w in slices(text):
            for match in shared.value.matches(w):
                found[w.first_row + match[0]] = True
        return pa.array(found)

    return lambda text: run(F.coalesce(text, F.lit("")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents whose text holds no item, with all their columns; no shuffle."""
    for index in _blocks(benchmark):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(index))(F.col("text")))
    return docs
