"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its byte n-grams of three to five bytes,
its neighbouring white space included, so a misspelt word keeps most of a known
word's vector. A window of ``WINDOW`` words is the mean of its words; a linear
softmax over it gives two classes. A toxic passage may be a few words of a long
text, so a text is scored by its most toxic window (any window position, found
from running sums) and not by the mean of the whole, in which it would drown.

Training takes a bounded sample (``rows_per_class`` labelled texts of either
class) and all windows of its texts. The sample is written to the shared folder
and read in parts; the driver holds one number for each word of it, and the
n-grams of each distinct word once. Only
texts are labelled, so it goes in rounds: at first every window carries its
text's label; later, of a toxic text only its most toxic windows count, and all
windows of the others. Embeddings and softmax are fitted together by AdaGrad. A
quarter of the sample is kept out of that and fits the scale and offset that
turn a text's margin into a probability.

Scoring is one pass over whole texts without a shuffle. As everything after the
embedding is linear, a word's margin is the mean of its n-grams' margins, and
only one number for each n-gram slot (``2 ** BITS`` floats) is broadcast.

Defined results: a null or empty text has no window and scores as the mean
margin of nothing, the intercept. Repeated rows score alike. Where the sample
lacks a class the score is the smoothed share of toxic rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.textblock import Words, release_memory, slices
from starloom.llm.training_rows import fold, labelled_sample
from starloom.sinks.staging import stage

BITS = 17
DIM = 8
SIZES = (3, 4, 5)
WINDOW = 4
ROWS_PER_CLASS = 1200
#: Bytes of the sample's texts that the driver reads at a time.
PART_BYTES = 16 << 20
LEAST_TEXTS = 3
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def subword_slots(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(word, slot)`` of the n-grams of each size.

    Words are laid out with one space on either side; an n-gram lies within
    one word and the spaces around it.
    """
    n = len(w.start)
    if not n:
        return
    length = w.end - w.start
    begin = np.concatenate([[0], np.cumsum(length + 1)])   # of the space before each word
    total = int(begin[-1]) + 1
    text = np.full(total + 8, 32, np.uint32)
    at = np.arange(total - 1) + np.repeat(w.start - begin[:-1] - 1, length + 1)
    at[begin[:-1]] = 0
    text[:total - 1] = _LOWER[w.data[at]]
    text[begin] = 32
    space = np.zeros(total + 8, bool)
    space[begin] = True
    space[total:] = True
    word = np.repeat(np.arange(n), length + 1)
    h = text[:-1] * np.uint32(0x01000193) + text[1:]
    clear = ~space[1:]                                     # no space strictly inside, so far
    for size in range(3, max(SIZES) + 1):
        h = h[:-1] * np.uint32(0x01000193) + text[size - 1:]
        good = clear[:len(h)][:total - 1] if size == 3 else clear[:total - 1]
        m = len(good)
        if size in SIZES:
            here = np.flatnonzero(good & (np.arange(m) + size <= total))
            v = (h[here] ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            yield word[here], ((v ^ (v >> np.uint32(15))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
        # an n-gram one longer has its last but one byte inside too
        k = min(m, len(space) - size)
        clear = good[:k] & ~space[size - 1:size - 1 + k]


def subwords(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(slot, count)``: n-gram slots word by word, and how many each word has."""
    parts = list(subword_slots(w))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = np.concatenate([o for o, _ in parts])
    order = np.argsort(own, kind="stable")
    return np.concatenate([s for _, s in parts])[order].astype(np.int64), np.bincount(own, minlength=len(w.start))


def word_margins(w: Words, margin: np.ndarray) -> np.ndarray:
    """Mean margin of the n-grams of each word (0 for a word too short to have any)."""
    total, count = np.zeros(len(w.start)), np.zeros(len(w.start))
    for word, slot in subword_slots(w):
        total += np.bincount(word, margin[slot], minlength=len(total))
        count += np.bincount(word, minlength=len(total))
    return total / np.maximum(count, 1)


def text_margins(column: pa.Array, margin: np.ndarray, intercept: float, window: int = WINDOW) -> np.ndarray:
    """The margin of the most toxic window of each whole text."""
    out = []
    for w in slices(column):
        best = np.full(w.rows, intercept)
        if len(w.start):
            run = np.concatenate([[0.0], np.cumsum(word_margins(w, margin))])
            counts = w.counts
            first = np.cumsum(counts) - counts
            size = np.minimum(window, counts)[w.row]
            # the window that begins at a word, moved back where the text ends
            begin = np.minimum(np.arange(len(w.row)), (first + counts)[w.row] - size)
            mean = (run[begin + size] - run[begin]) / size
            has = np.flatnonzero(counts)
            best[has] = intercept + np.maximum.reduceat(mean, first[has])
        out.append(best)
    return np.concatenate(out) if out else np.zeros(0)


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first .. first + size - 1`` of each run."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class Bags:
    """Windows as words and words as n-gram slots: a window is the mean over its words of the mean over their n-grams."""

    def __init__(self):
        self.rows = 0
        self._hash, self._number = np.zeros(0, np.uint64), np.zeros(0, np.int32)     # of the words met, by hash
        self._slots, self._counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        self._words, self._sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]

    def add(self, texts: pa.Array, window: int | None = None) -> np.ndarray:
        """Add the windows of ``window`` successive words of each text (None: its whole); each window's text."""
        of = [np.zeros(0, np.int64)]
        for w in slices(texts):
            ids, first, place = np.unique(w.hash, return_index=True, return_inverse=True)
            at = np.searchsorted(self._hash, ids)
            known = np.append(self._hash, np.uint64(0))[at] == ids
            known &= at < len(self._hash)
            fresh = np.flatnonzero(~known)
            number = np.empty(len(ids), np.int32)
            number[known] = self._number[at[known]]
            number[fresh] = len(self._hash) + np.arange(len(fresh))
            self._hash = np.insert(self._hash, at[fresh], ids[fresh])
            self._number = np.insert(self._number, at[fresh], number[fresh])
            new = first[fresh]
            slot, count = subwords(replace(w, row=w.row[new], start=w.start[new], end=w.end[new], hash=w.hash[new]))
            self._slots.append(slot.astype(np.int32))
            self._counts.append(count.astype(np.int32))
            counts = w.counts
            n = np.ones(w.rows, np.int64) if window is None else -(-counts // window)
            text = np.repeat(np.arange(w.rows), n)
            size = counts if window is None else np.minimum(window, counts[text] - _runs(np.zeros(w.rows, np.int64), n) * window)
            self._words.append(number[place])
            self._sizes.append(size.astype(np.int32))
            of.append(w.first_row + text)
            self.rows += len(text)
        return np.concatenate(of)

    def close(self) -> Bags:
        """To be called when all texts are in."""
        self.slot, count = np.concatenate(self._slots), np.concatenate(self._counts)
        self.word, self.size = np.concatenate(self._words), np.concatenate(self._sizes).astype(np.int64)
        self._slots = self._counts = self._words = self._sizes = None
        self.slot_cut = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        self.share = 1 / np.maximum(count, 1)                    # of an n-gram in its word
        self.cut = np.concatenate([[0], np.cumsum(self.size)])
        return self

    def _slots_of(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(position in word, slot)``."""
        size = self.slot_cut[word + 1] - self.slot_cut[word]
        return np.repeat(np.arange(len(word)), size), self.slot[_runs(self.slot_cut[word], size)]

    def drop_rare(self, doc: np.ndarray, least: int, step: int = 20_000) -> np.ndarray:
        """Drop n-grams of fewer than ``least`` documents (``doc``: of each window, ascending); the slots kept."""
        seen = np.zeros(1 << BITS, np.int64)
        first = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), self.rows)    # a document's first window
        ends = [0, *[int(f) for f, g in zip(first[1:], first[:-1]) if f // step > g // step], self.rows]
        for a, b in zip(ends, ends[1:]):
            words = np.unique(np.repeat(doc[a:b], self.size[a:b]) * len(self.share) + self.word[self.cut[a]:self.cut[b]])
            own, slot = self._slots_of(words % len(self.share))
            pairs = np.unique((words // len(self.share))[own] * (1 << BITS) + slot)
            seen += np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
        kept = seen >= least
        here = kept[self.slot]
        run = np.concatenate([[0], np.cumsum(here)])
        self.slot, self.slot_cut = self.slot[here], run[self.slot_cut]
        return kept

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(position in rows, slot, weight)`` of the chosen windows."""
        size = self.size[rows]
        window, word = np.repeat(np.arange(len(rows)), size), self.word[_runs(self.cut[rows], size)]
        at, slot = self._slots_of(word)
        own = window[at]
        return own, slot, (self.share[word][at] / size[own]).astype(np.float32)

    def means(self, margin: np.ndarray) -> np.ndarray:
        """Of each window, from the n-grams' margins."""
        run = np.concatenate([[0.0], np.cumsum(margin[self.slot])])
        word = (run[self.slot_cut[1:]] - run[self.slot_cut[:-1]]) * self.share
        run = np.concatenate([[0.0], np.cumsum(word[self.word])])
        return (run[self.cut[1:]] - run[self.cut[:-1]]) / np.maximum(self.size, 1)


class Model:
    """Embeddings and a two-class softmax, fitted together."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((1 << BITS, DIM)) * 0.05).astype(np.float32)
        self.out = (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self._seen = [np.full_like(p, 1e-6) for p in (self.table, self.out, self.bias)]

    def _step(self, k: int, p: np.ndarray, g: np.ndarray, rate: float, at=slice(None)) -> None:
        self._seen[k][at] += g * g
        p[at] -= rate * g / np.sqrt(self._seen[k][at])

    def fit_batch(self, bags: Bags, rows: np.ndarray, y: np.ndarray, share: np.ndarray, rate: float) -> None:
        """One AdaGrad step on the cross entropy of the rows, weighted by ``share``."""
        own, slot, weight = bags.take(rows)
        part = self.table[slot] * weight[:, None]
        mean = np.stack([np.bincount(own, part[:, d], minlength=len(rows)) for d in range(DIM)], 1)
        z = mean @ self.out + self.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(rows)), y] -= 1
        p *= share[:, None] / share.sum()
        back = p @ self.out.T
        used, where = np.unique(slot, return_inverse=True)
        g = np.stack([np.bincount(where, back[own, d] * weight, minlength=len(used)) for d in range(DIM)], 1)
        self._step(1, self.out, (mean.T @ p).astype(np.float32), rate * 0.2)
        self._step(2, self.bias, p.sum(0).astype(np.float32), rate * 0.2)
        self._step(0, self.table, g.astype(np.float32), rate, used)

    def margins(self) -> tuple[np.ndarray, float]:
        """Of each n-gram slot, and the intercept: toxic minus other."""
        d = self.out[:, 1] - self.out[:, 0]
        return (self.table @ d).astype(np.float64), float(self.bias[1] - self.bias[0])

    def scores(self, bags: Bags) -> np.ndarray:
        margin, bias = self.margins()
        return bias + bags.means(margin)


def fit(texts: pa.Array, doc: np.ndarray, label: np.ndarray, *, rounds: int = 4, batch: int = 1024,
        rate: float = 0.3) -> tuple[np.ndarray, float]:
    """N-gram margins and intercept from windows: their text, the number and the label of their document."""
    bags = Bags()
    bags.add(texts)
    return fit_bags(bags.close(), doc, label, rounds=rounds, batch=batch, rate=rate)


def fit_bags(bags: Bags, doc: np.ndarray, label: np.ndarray, *, rounds: int = 4, batch: int = 1024,
             rate: float = 0.3) -> tuple[np.ndarray, float]:
    """As ``fit``, from windows that are in bags, those of a document in one run."""
    docs, first = np.unique(doc, return_index=True)
    ones = int(label[first].sum()) if len(docs) else 0
    if not 0 < ones < len(docs):
        share = (ones + 0.5) / (len(docs) + 1)
        return np.zeros(1 << BITS), float(np.log(share / (1 - share)))
    model, rng = Model(), np.random.default_rng(11)
    # what only one or two texts have says nothing of others; it keeps the margin 0
    model.table[~bags.drop_rare(doc, LEAST_TEXTS)] = 0
    chosen, y = np.arange(bags.rows), label.astype(np.int64)
    for turn in range(rounds):
        if turn:
            z = model.scores(bags)
            # the windows of a toxic document that are not far from its most toxic one
            top = np.full(int(doc.max()) + 1, -np.inf)
            np.maximum.at(top, doc, z)
            good = (label == 1) & (z >= np.maximum(top[doc] - 1.0, 0.0)) | (label == 1) & (z == top[doc])
            chosen = np.flatnonzero(good | (label == 0))
        positives = y[chosen].sum()
        share = np.where(y[chosen] == 1, 0.5 / max(positives, 1), 0.5 / max(len(chosen) - positives, 1)) * len(chosen)
        if turn:  # a clean text has many windows, all of which must stay below the threshold
            share = np.where(y[chosen] == 1, share, share * 2)
        size = min(batch, max(64, len(chosen) // 40))
        order = np.concatenate([rng.permutation(len(chosen)) for _ in range(1 + 100 * size // len(chosen))])
        for a in range(0, len(order), size):
            part = order[a:a + size]
            model.fit_batch(bags, chosen[part], y[chosen[part]], share[part], rate)
    margin, bias = model.margins()
    return margin, bias


def sample_bags(sample: DataFrame) -> tuple[Bags, np.ndarray, np.ndarray]:
    """All windows of the texts of a staged sample, the number of each window's document and its label."""
    size = sample.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    bags, doc, label = Bags(), [], []
    for k in range(parts):
        got = sample.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == k).toArrow()
        got = got.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        of = bags.add(got["text"], WINDOW)
        doc.append(np.unique(got["doc_id"].to_numpy(), return_inverse=True)[1][of] + sum(len(np.unique(d)) for d in doc))
        label.append(got["label"].to_numpy().astype(np.int64)[of])
    return bags.close(), np.unique(np.concatenate(doc), return_inverse=True)[1], np.concatenate(label)


def calibrate(z: np.ndarray, y: np.ndarray, *, ridge: float = 0.02) -> tuple[float, float]:
    """``(scale, offset)`` of a one-feature logistic regression of the label on the margin (Newton steps).

    The sample's classes are drawn apart, so they are weighted as if a quarter of all texts were toxic.
    """
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    x = np.stack([z, np.ones_like(z)], 1)
    weight = np.where(y == 1, 0.25 / y.sum(), 0.75 / (len(y) - y.sum())) * len(y)
    keep = np.diag([ridge * len(y), 1e-3 * len(y)])
    centre, theta = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        g = x.T @ (weight * (p - y)) + keep @ (theta - centre)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + keep, g)
        theta = theta - step / max(1.0, float(np.abs(step).max()))
    return max(float(theta[0]), 0.05), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = FOLDS,
          held_out_fold: int = HELD_OUT_FOLD, rows_per_class: int = ROWS_PER_CLASS) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out_fold,
                             rows_per_class=rows_per_class)

    kept_out = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(4)) == 0

    sample = stage(sample, "toxicity-sample")
    margin, intercept = fit_bags(*sample_bags(sample.where(~kept_out)))
    release_memory()  # the driver's, for the steps that follow
    shared = docs.sparkSession.sparkContext.broadcast(margin)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = text_margins(batch.column("text"), shared.value, intercept)
            yield pa.RecordBatch.from_arrays([pa.array(z), batch.column("label")], ["margin", "label"])

    got = sample.where(kept_out).mapInArrow(measure, "margin double, label int").toArrow()
    scale, offset = calibrate(got["margin"].to_numpy(), got["label"].to_numpy().astype(np.float64))
    return margin * scale, intercept * scale + offset


def probability(spark: SparkSession, model: tuple[np.ndarray, float]) -> Callable[[Column], Column]:
    """A column function: the probability that a whole text is toxic."""
    margin, intercept = model
    shared = spark.sparkContext.broadcast(margin)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(text_margins(text, shared.value, intercept), -35, 35))))

    return lambda text: run(F.coalesce(text, F.lit("")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, folds: int = FOLDS,
                    held_out_fold: int = HELD_OUT_FOLD) -> DataFrame:
    """Per document: ``doc_id``, ``held_out`` (false without an id), ``score`` (0 to 1) and ``predicted``."""
    model = train(docs, labels, folds=folds, held_out_fold=held_out_fold)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       probability(docs.sparkSession, model)(F.col("text")).alias("score"))
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out_fold, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
