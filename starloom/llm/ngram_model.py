"""Language-model scores from a sharded Elias-Fano bigram trie.

The model is an interpolated bigram model over the words and one end mark of
each training text: ``p(w | v) = (1 - l) c(v w) / c(v) + l p(w)``, where ``p(w)`` is
the smoothed unigram probability of the base score (all unseen words are one)
and ``l`` depends on the size of ``c(v)`` (a power of two); after an unseen word
or for unseen pairs it backs off to ``l p(w)``. Probabilities are kept in
16-bit codes rounded down, so they sum to at most one.

Counts cover all training texts, and the model grows with them, so it is cut
into shards by pair: by ``v`` and a few bits of ``w``, which spreads the
successors of a hot word over many shards. Three scans feed three shuffles:

1. distinct words of each batch with their counts, and the shards that ask for
   them; what flows on to each shard is the counts of its words;
2. the pairs of each batch's training texts by shard, as indexes into the
   block's words. A shard meets its pairs and its counts in one task of about
   ``SHARD_PAIRS`` pairs. The weights ``l`` are fitted by leaving one occurrence
   out: a shard's log likelihoods are a table of fixed size, which Spark adds up
   over all shards, so every training pair counts;
3. the pairs of all texts, likewise, in flushes of texts that are known by their place in the
   flush. A shard builds its trie, looks all pairs up, and sends each flush the sums of its texts;
   the flush's keys travel once, with its first block.

Words are known by 48 bits of their hash.

Defined results: a null or empty text is one end mark. Repeated rows score
alike and each count in training. Without training texts all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.elias_fano import BigramTrie, Quantiser
from starloom.llm.textblock import mix, release_memory, slices
from starloom.llm.training_rows import fold
from starloom.sinks.staging import stage

FOLDS, HELD_OUT_FOLD = 5, 1
SHARD_PAIRS = 2_000_000
#: Pairs of a batch that are sent together.
FLUSH_PAIRS = 2_000_000
#: Tables of sums that reach the driver.
FIT_TABLES = 32
SIZES = 40
GRID = np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999])

_U = np.uint64
_SUM_NAMES, _SUMS = ("base", "score", "known", "n"), ("<f8", "<f8", "<u4", "<u4")
_START, _END = (int(v) >> 16 for v in mix(np.array([1, 2], _U)))


def _pack(words: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel().astype(np.int64)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending: by sorting, as ``np.unique`` without counts hashes them, many times slower."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def shard_of(first: np.ndarray, second: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each pair: by the first word and four bits of the second."""
    h = mix(first.astype(_U) * _U(31) + (second.astype(_U) >> _U(44))) >> _U(32)
    return ((h * _U(shards)) >> _U(32)).astype(np.int64)


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per flush: ``(rows, first word, second word, position in rows)`` of all pairs of successive texts."""
    rows, first, second, own, n, done = [], [], [], [], 0, 0
    for w in slices(batch.column("text")):
        words = (w.hash >> _U(16)).astype(np.int64)
        at = np.arange(len(words)) + w.row
        total = len(words) + w.rows
        ends = np.cumsum(w.counts + 1)
        a, b = np.empty(total, np.int64), np.empty(total, np.int64)
        b[at], a[at + 1 if len(at) else at] = words, words
        b[ends - 1], a[ends - w.counts - 1] = _END, _START
        rows.append(np.arange(w.first_row, w.first_row + w.rows))
        first.append(a)
        second.append(b)
        own.append(np.repeat(np.arange(w.rows), w.counts + 1) + done)
        n, done = n + total, done + w.rows
        if n >= FLUSH_PAIRS:
            yield tuple(map(np.concatenate, (rows, first, second, own)))
            rows, first, second, own, n, done = [], [], [], [], 0, 0
    if rows:
        yield tuple(map(np.concatenate, (rows, first, second, own)))


def _width(most: int) -> str:
    """The narrowest type for numbers below ``most``."""
    return "<u2" if most <= 1 << 16 else "<u4" if most <= 1 << 32 else "<i8"


def _word_blocks(rows: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Distinct words by bucket: their training counts, and the shards that have pairs with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            for row, a, b, own in _pairs(batch):
                learn = train[row][own]
                shard = shard_of(a, b, shards)
                # a pair's second word is the first of the next pair, or the end mark
                words, first = np.unique(a, return_inverse=True)
                words, first = np.append(words, _END), first.astype(np.int32)
                second = np.where(b == _END, np.int32(len(words) - 1), np.roll(first, -1))
                n = np.bincount(second[learn], minlength=len(words))
                n[words == _START] = (learn & (a == _START)).sum()
                del a, b
                asks = _distinct(np.concatenate([first, second]) * np.int64(shards) + np.tile(shard, 2))
                word, shard = asks // shards, asks % shards
                bucket = (mix(words.astype(_U)) % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket[word], kind="stable")
                word, shard = word[order], shard[order]
                cut = np.searchsorted(bucket[word], np.arange(buckets + 1))
                out = []
                for k in range(buckets):
                    part = slice(cut[k], cut[k + 1])
                    if cut[k] < cut[k + 1]:
                        ids, runs = np.unique(word[part], return_counts=True)
                        out.append((k, _pack(words[ids]), n[ids].astype("<u4").tobytes(), runs.astype("<u4").tobytes(),
                                    shard[part].astype(_width(shards)).tobytes()))
                cols = list(zip(*out))
                del words, first, second, asks, word, shard, bucket, order, learn
                release_memory()
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                                 ["bucket", "words", "counts", "runs", "shards"])

    return rows.select("text", "train").mapInArrow(run, "bucket int, words binary, counts binary, runs binary, shards binary")


def _counts_by_shard(blocks: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``words`` and ``counts`` for the shards that ask; shard -1: ``tokens`` and ``types`` of a bucket."""
    width = _width(shards)

    def run(group: pa.Table) -> pa.Table:
        words, counts, runs, places = (group[c].to_pylist() for c in ("words", "counts", "runs", "shards"))
        word = np.concatenate([_unpack(w) for w in words])
        count = np.concatenate([np.frombuffer(c, "<u4") for c in counts]).astype(np.int64)
        runs = np.concatenate([np.frombuffer(r, "<u4") for r in runs])
        shard = np.concatenate([np.frombuffer(s, width) for s in places]).astype(np.int64)
        ids, at = np.unique(word, return_inverse=True)
        total = np.bincount(at, count, minlength=len(ids)).astype(np.int64)
        asks = _distinct(shard * len(ids) + np.repeat(at, runs))
        shard, at = asks // len(ids), asks % len(ids)
        known = total[at] > 0
        shard, at = shard[known], at[known]
        cut = np.flatnonzero(np.diff(shard, prepend=-1))
        kind = _width(int(total.max()) + 1)
        out = [(int(shard[a]), _pack(ids[at[a:b]]), total[at[a:b]].astype(kind).tobytes(), 0, 0)
               for a, b in zip(cut, np.append(cut[1:], len(shard)))]
        token = (total > 0) & (ids != _START)
        out.append((-1, b"", b"", int(total[token].sum()), int(token.sum())))
        cols = list(zip(*out))
        return pa.Table.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()),
                                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                                    ["shard", "words", "counts", "tokens", "types"])

    return blocks.groupBy("bucket").applyInArrow(run, "shard int, words binary, counts binary, tokens long, types long")


def _pair_blocks(rows: DataFrame, shards: int, *, by_text: bool) -> DataFrame:
    """Pairs by shard: texts (places in their flush) with their runs, words, and both words' places among them.

    A flush is known by its partition and number, which a repeated task gives again; its first block has the keys of its
    texts. Unless ``by_text``, a block's pairs are those of its training texts and are sent as the run of one text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not by_text:
                batch = batch.filter(batch.column("train"))
            if not len(batch):
                continue
            train = batch.column("train").to_numpy(zero_copy_only=False)
            key = batch.column("key").to_numpy(zero_copy_only=False)
            for row, a, b, own in _pairs(batch):
                if not by_text:
                    own, row = np.zeros(len(a), np.int64), row[:1]
                shard = shard_of(a, b, shards)
                order = np.argsort(shard.astype(np.uint16) if shards < 65536 else shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                out, names, place = [], key[row].astype("<i8").tobytes() if by_text else b"", _width(len(row))
                flush += 1
                for k in range(shards):
                    part = order[cut[k]:cut[k + 1]]
                    if not len(part):
                        continue
                    words, at = np.unique(np.concatenate([a[part], b[part]]), return_inverse=True)
                    starts = np.flatnonzero(np.diff(own[part], prepend=-1))      # the sort is stable: texts ascend
                    texts, runs = own[part[starts]], np.diff(starts, append=len(part))
                    small = "<u2" if len(words) < 65536 else "<u4"
                    out.append((k, flush, names, texts.astype(place).tobytes(), np.packbits(train[row[texts]]).tobytes(),
                                runs.astype("<u4").tobytes(), _pack(words), at.astype(small).tobytes()))
                    names = b""
                if out:
                    cols = list(zip(*out))
                    del shard, order, out
                    release_memory()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[2:])],
                        ["shard", "flush", "keys", "texts", "train", "runs", "words", "places"])

    return rows.select("key", "text", "train").mapInArrow(
        run, "shard int, flush long, keys binary, texts binary, train binary, runs binary, words binary, places binary")


class Shard:
    """The pairs of a shard and the counts of their words."""

    def __init__(self, blocks: pa.Table, counts: pa.Table, tokens: int, types: int):
        words = [_unpack(w) for w in counts["words"].to_pylist()] or [np.zeros(0, np.int64)]
        n = [np.frombuffer(c, f"<i{len(c) // len(w)}" if len(c) == 8 * len(w) else f"<u{len(c) // len(w)}").astype(np.int64)
             for c, w in zip(counts["counts"].to_pylist(), words)] or [np.zeros(0, np.int64)]
        words, n = np.concatenate(words), np.concatenate(n)
        order = np.argsort(words)
        words, self.count = words[order], np.append(n[order], 0)          # the last id is that of unseen words
        self.unseen = len(words)
        first, second, train, own, self.ends = [], [], [], [], [0]
        columns = [blocks[c] for c in ("words", "runs", "places", "train")]
        for k in range(len(blocks)):
            block = dict(zip(("words", "runs", "places", "train"), (c[k].as_buffer() for c in columns)))  # no copy
            known = _unpack(block["words"])
            at = np.minimum(np.searchsorted(words, known), max(len(words) - 1, 0))
            ids = np.where(words[at] == known, at, self.unseen) if len(words) else np.full(len(known), self.unseen)
            runs = np.frombuffer(block["runs"], "<u4").astype(np.int64)
            total = int(runs.sum())
            place = np.frombuffer(block["places"], "<u2" if len(known) < 65536 else "<u4")
            first.append(ids[place[:total]].astype(np.int32))
            second.append(ids[place[total:]].astype(np.int32))
            flags = np.unpackbits(np.frombuffer(block["train"], np.uint8), count=len(runs)).astype(bool)
            train.append(np.repeat(flags, runs))
            own.append(np.repeat(np.arange(len(runs), dtype=np.int32) + self.ends[-1], runs))
            self.ends.append(self.ends[-1] + len(runs))
        self.own = np.concatenate(own)
        pair = np.concatenate(first).astype(np.int64) * (self.unseen + 1) + np.concatenate(second)
        train = np.concatenate(train)
        del first, second, own, columns
        self.pairs, self.at = np.unique(pair, return_inverse=True)        # distinct pairs, of all texts
        self.seen = np.bincount(self.at[train], minlength=len(self.pairs))
        self.at = self.at.astype(np.int32)
        self.first, self.second = self.pairs // (self.unseen + 1), self.pairs % (self.unseen + 1)
        self.unigram = (self.count + 0.5) / (tokens + 0.5 * (types + 1))

    @property
    def size(self) -> np.ndarray:
        """The power of two of each word's count."""
        return np.minimum(np.log2(np.maximum(self.count, 1)).astype(np.int64), SIZES - 1)

    def left_out(self) -> np.ndarray:
        """Log likelihood of the training pairs with one occurrence left out, by context size and weight."""
        rows = np.flatnonzero((self.seen > 0) & (self.count[self.first] > 1))
        c, context = self.seen[rows], self.count[self.first[rows]]
        share, low = (c - 1) / (context - 1), self.unigram[self.second[rows]]
        size = self.size[self.first[rows]]
        return np.stack([np.bincount(size, c * np.log((1 - g) * share + g * low), minlength=SIZES) for g in GRID], 1)

    def scores(self, weights: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(base, score, known, tokens)`` of each text's pairs; block ``k`` has the texts from ``ends[k]`` on."""
        weight = weights[self.size]
        rows = np.flatnonzero(self.seen)
        first, second = self.first[rows], self.second[rows]
        p = (1 - weight[first]) * self.seen[rows] / np.maximum(self.count[first], 1) + weight[first] * self.unigram[second]
        trie = BigramTrie(first, second, np.log10(p))
        base = np.log10(self.unigram)
        unigram = Quantiser.logs(Quantiser.codes(base))
        backoff = np.where(self.count > 0, Quantiser.logs(Quantiser.codes(np.log10(weight))), 0.0)
        found, logs = trie.find(self.first, self.second)
        logs = np.where(found, logs, backoff[self.first] + unigram[self.second])
        n = self.ends[-1]
        second = self.second[self.at]
        return (np.bincount(self.own, base[second], minlength=n), np.bincount(self.own, logs[self.at], minlength=n),
                np.bincount(self.own, self.count[second] > 0, minlength=n).astype(np.int64), np.bincount(self.own, minlength=n))


def _weights(sums: np.ndarray) -> np.ndarray:
    """The best weight of each context size; sizes without data take their neighbour's."""
    best, has = GRID[sums.argmax(1)], np.flatnonzero(sums.any(1))
    if not len(has):
        return np.full(SIZES, 0.9)
    return best[has[np.abs(np.arange(SIZES)[:, None] - has).argmin(1)]]


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Frames made meanwhile drop their shuffle files as soon as they have been run, not at some later collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def language_scores(docs: DataFrame, *, folds: int = FOLDS, held_out_fold: int = HELD_OUT_FOLD,
                    shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    held_out = F.coalesce(fold(doc_id, folds) == held_out_fold, F.lit(False))
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("key"), (~held_out).alias("train"))
    # about one pair to six bytes of text; only how many tasks share the work depends on it
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // 6 // shard_pairs))

    with _shuffles_dropped(docs.sparkSession):
        counts = stage(_counts_by_shard(_word_blocks(rows, shards, shards), shards), "ngram-counts")
    total = counts.where("shard = -1").agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = total[0] or 0, total[1] or 0
    of_words = counts.where("shard >= 0").select("shard", "words", "counts").groupBy("shard")

    def fit(key, blocks: pa.Table, words: pa.Table) -> pa.Table:
        sums = Shard(blocks, words, tokens, types).left_out() if len(blocks) else np.zeros((SIZES, len(GRID)))
        release_memory()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

    def add_tables(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        tables = [np.frombuffer(s) for s in group.sort_by("shard")["sums"].to_pylist()]     # the same order in every run
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([sum(tables).tobytes()], pa.binary())})

    with _shuffles_dropped(docs.sparkSession):
        fitted = (_pair_blocks(rows, shards, by_text=False).groupBy("shard").cogroup(of_words)
                  .applyInArrow(fit, "shard int, sums binary")
                  .groupBy((F.col("shard") % FIT_TABLES).alias("part")).applyInArrow(add_tables, "part int, sums binary").toArrow())
    weights = _weights(sum((np.frombuffer(s).reshape(SIZES, -1) for s in fitted.sort_by("part")["sums"].to_pylist()),
                           np.zeros((SIZES, len(GRID)))))

    def look_up(key, blocks: pa.Table, words: pa.Table) -> pa.Table:
        out = []
        if len(blocks):
            shard = Shard(blocks, words, tokens, types)
            cols = shard.scores(weights)
            out = [(*(blocks[c][k].as_py() for c in ("flush", "keys", "texts")), *(c[a:b].astype(t).tobytes() for c, t in zip(cols, _SUMS)))
                   for k, (a, b) in enumerate(zip(shard.ends, shard.ends[1:]))]
        release_memory()
        cols = list(zip(*out)) or [[]] * (3 + len(_SUMS))
        return pa.Table.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                    ["flush", "keys", "texts", *_SUM_NAMES])

    def add_up(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), "<i8")
        sums = [np.zeros(len(keys)) for _ in _SUMS]
        texts = table["texts"]
        for k in range(len(texts)):
            at = np.frombuffer(texts[k].as_buffer(), _width(len(keys)))
            for total, name, kind in zip(sums, _SUM_NAMES, _SUMS):
                total[at] += np.frombuffer(table[name][k].as_buffer(), kind)
        return pa.table({"key": keys, **dict(zip(_SUM_NAMES, sums))})

    sums = (_pair_blocks(rows, shards, by_text=True).groupBy("shard").cogroup(of_words)
            .applyInArrow(look_up, "flush long, keys binary, texts binary, base binary, score binary, known binary, n binary")
            .groupBy("flush").applyInArrow(add_up, "key long, base double, score double, known double, n double"))
    # rows that repeat an id and a text share a key and have the same sums
    sums = sums.groupBy("key").agg(*(F.max(c).alias(c) for c in _SUM_NAMES))
    return rows.select("doc_id", "key", (~F.col("train")).alias("held_out")).join(sums, "key").select(
        "doc_id", "held_out", F.col("n").cast("long").alias("n_tokens"), F.col("known").cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
