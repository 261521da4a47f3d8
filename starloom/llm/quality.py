"""Quality classifier: logistic regression on hashed word n-grams, fitted with FTRL-proximal.

A text's features are its word n-grams, hashed into ``2 ** BITS`` slots: single
words, word pairs, and single, paired and tripled word shapes (case, the kind
of the first and last byte, length), so that layout and junk are seen in words
the model never met. A pair of equal words shares one slot, whatever the word.
A feature's value is its share of the text's words, so a text's logit is a
sparse dot product of those shares with the weights, whatever its length.

Fitting takes a bounded sample (``rows_per_class`` rows of either class; see
``labelled_sample``): executors turn texts into sparse rows, the driver runs
FTRL over them in a fixed order. Scoring is one pass over whole texts, without
a shuffle; the weights (a fixed ``2 ** BITS`` floats) are broadcast.

Defined results: a null or empty text, or one of white space only, has no
feature and scores the intercept. Repeated rows score alike. With no labelled
row, or one class only, the intercept is that of the smoothed share of ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.textblock import Words, mix, release_memory, slices
from starloom.llm.training_rows import fold, labelled_sample

BITS = 18
ROWS_PER_CLASS = 3000
FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3

_U = np.uint64
_KIND = np.full(256, 4, np.uint8)          # other signs
_KIND[97:123] = 0                          # lower case
_KIND[128:] = 0                            # part of a longer character
_KIND[65:91] = 1                           # upper case
_KIND[48:58] = 2                           # digit
_KIND[[33, 44, 46, 58, 59, 63]] = 3        # ! , . : ; ?


def _shape(w: Words) -> np.ndarray:
    """A small number for a word's case, first and last byte kind and length."""
    kind = _KIND[w.data]
    upper = np.add.reduceat((kind == 1).astype(np.int32), w.start)
    signs = np.add.reduceat((kind >= 3).astype(np.int32), w.start)
    length = w.end - w.start
    shape = kind[w.start].astype(np.int64) * 5 + kind[w.end - 1]
    shape = shape * 3 + np.minimum(upper, 2)
    shape = shape * 4 + np.minimum(signs, 3)
    return shape * 6 + np.minimum(length // 3, 5)


def ngram_slots(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(row, slot)`` of every n-gram of every kind."""
    if not len(w.hash):
        return []
    shape = mix(_shape(w).astype(_U) + _U(0xABCD01))
    same2 = w.row[1:] == w.row[:-1]
    same3 = same2[1:] & same2[:-1]
    pair = mix(w.hash[:-1] * _U(3) + w.hash[1:])
    pair[w.hash[:-1] == w.hash[1:]] = _U(0x5A5A5A)
    kinds = [(w.row, w.hash ^ _U(1)), (w.row[1:][same2], pair[same2] ^ _U(2)), (w.row, shape),
             (w.row[1:][same2], mix(shape[:-1] * _U(5) + shape[1:])[same2]),
             (w.row[2:][same3], mix(shape[:-2] * _U(25) + shape[1:-1] * _U(5) + shape[2:])[same3])]
    return [(row, (h >> _U(64 - BITS)).astype(np.int64)) for row, h in kinds]


def sparse_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(slots, shares)`` of each text: its distinct features and their shares."""
    for w in slices(column):
        parts = ngram_slots(w)
        counts = np.maximum(w.counts, 1)
        if not parts:
            for _ in range(w.rows):
                yield np.zeros(0, np.int32), np.zeros(0, np.float32)
            continue
        key = np.concatenate([(row << BITS) | slot for row, slot in parts])
        key, n = np.unique(key, return_counts=True)
        row = key >> BITS
        value = (n / counts[row]).astype(np.float32)
        cut = np.searchsorted(row, np.arange(w.rows + 1))
        slot = (key & ((1 << BITS) - 1)).astype(np.int32)
        for a, b in zip(cut[:-1], cut[1:]):
            yield slot[a:b], value[a:b]


class Ftrl:
    """Follow-the-regularised-leader (proximal) for logistic loss, one row at a time."""

    def __init__(self, slots: int, *, alpha: float = 0.5, beta: float = 0.05, l1: float = 1e-4, l2: float = 1e-4):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(slots + 1)
        self.n = np.zeros(slots + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], *, epochs: int = 4) -> tuple[np.ndarray, float]:
    """Weights and intercept from ``(slots, shares, label)`` rows; the order of passes is fixed."""
    size = 1 << BITS
    ones = sum(y for _, _, y in rows)
    if not 0 < ones < len(rows):
        share = (ones + 0.5) / (len(rows) + 1)
        return np.zeros(size, np.float32), float(np.log(share / (1 - share)))
    model = Ftrl(size)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            slots, shares, y = rows[i]                   # kept narrow; widened one at a time
            model.update(np.append(slots, size).astype(np.int64), np.append(shares, 1.0), y)
    w = model.weights(slice(None))
    return w[:size].astype(np.float32), float(w[size])


def logits(column: pa.Array, weights: np.ndarray, intercept: float) -> np.ndarray:
    """The logit of each whole text."""
    out = []
    for w in slices(column):
        total = np.zeros(w.rows)
        for row, slot in ngram_slots(w):
            total += np.bincount(row, weights[slot], minlength=w.rows)
        out.append(intercept + total / np.maximum(w.counts, 1))
    return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = FOLDS,
          held_out_fold: int = HELD_OUT_FOLD, rows_per_class: int = ROWS_PER_CLASS) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, label, fold(F.col("doc_id"), folds) != held_out_fold,
                             rows_per_class=rows_per_class)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(sparse_rows(batch.column("text")))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "slots": pa.array([s.tobytes() for s, _ in found], pa.binary()),
                "shares": pa.array([v.tobytes() for _, v in found], pa.binary())})

    got = sample.mapInArrow(featurise, "doc_id long, label int, slots binary, shares binary").toArrow()
    rows = sorted(zip(*(got.column(c).to_pylist() for c in ("doc_id", "slots", "shares", "label"))))
    del got
    model = fit([(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32), y) for _, s, v, y in rows])
    del rows
    release_memory()  # the driver's, for the steps that follow
    return model


def probability(spark: SparkSession, model: tuple[np.ndarray, float]) -> Callable[[Column], Column]:
    """A column function: the probability of label 1 of a text."""
    weights, intercept = model
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(logits(text, shared.value, intercept), -35, 35))))

    return lambda text: run(F.coalesce(text, F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, folds: int = FOLDS,
                   held_out_fold: int = HELD_OUT_FOLD) -> DataFrame:
    """Per document: ``doc_id``, ``held_out`` (false without an id), ``score`` (0 to 1) and ``predicted``."""
    model = train(docs, labels, folds=folds, held_out_fold=held_out_fold)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       probability(docs.sparkSession, model)(F.col("text")).alias("score"))
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out_fold, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
