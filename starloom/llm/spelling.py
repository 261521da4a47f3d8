"""Spelling variant grouping by dense prefix-suffix tiling (operator 12).

Two words are near if one inserted, deleted or replaced code point makes one of
the other. With ``p`` the length of their common prefix and ``s`` that of their
common suffix (neither longer than the shorter word), that is so exactly if
``p + s`` reaches the longer length minus one.

Words are compared by tiles: two blocks of words of length ``m`` (and ``m + 1``) lie
as padded matrices of code points, forwards and backwards, and ``p`` and ``s`` of all
their pairs are found column by column. Not every two blocks need to meet: of two near
words the shorter one, of length ``m``, shares with the longer its first ``m // 2`` code
points or else its last ``m - m // 2``. So words meet within cells, of a length
and such a half; a cell's rows lie together in the sorted stream of a task, and tiles
run along it. A cell of more than ``CELL_WORDS`` words is dealt into blocks of that size, and
each pair of blocks is a cell of its own, so no task ever holds more than two of them.
A pair is taken from the prefix cell if its prefix is that long, else from
the suffix cell, so it comes once.

A word's form is its commonest near word, if that is at least ``RATIO`` times as
common. Forms are followed by doubling: each round replaces a word's form by that
one's form, until nothing changes. As counts double along a chain, 64 bits of count
allow six rounds at most.

Rows: a null text has no words; a null id counts as an empty one in the hash that
alters words (it is the driver's way to plant misspellings, see ``planted_words``). Repeated rows count each
time. Extra columns are ignored. Words of any length are handled: the longer they are, the fewer
make a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.skew import whole_groups
from starloom.sinks.staging import stage

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2

#: Words of a block at most, and their code points.
CELL_WORDS = 4096
CELL_POINTS = 1 << 22
#: Words of a tile's side; rows of the stream that are worked at once.
TILE = 128
STREAM_ROWS = 1 << 16

_LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALTERED = 97


def planted_words(docs: DataFrame) -> DataFrame:
    """``word`` for every run of letters of every text; a run loses a code point where the hash of id and run says so."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(_LETTERS), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % _ALTERED == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and common enough."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _cells(counts: DataFrame) -> DataFrame:
    """Each word under its cells: ``tile`` (sorts them), ``m``, ``family`` (0 prefix, 1 suffix), ``role`` (1: longer), ``side``."""
    length = F.length("word")

    def cell(family: int, role: int) -> Column:
        m = length - role
        half = F.floor(m / 2).cast("int")
        text = F.col("word").substr(F.lit(1), half) if family == 0 else F.col("word").substr(length - (m - half) + 1, m - half)
        return F.struct(m.alias("m"), F.lit(family).alias("family"), F.lit(role).alias("role"),
                        F.xxhash64(F.lit(family), m, text).alias("cell"))

    every = counts.select("word", "n", F.explode(F.array(*[cell(f, r) for f in (0, 1) for r in (0, 1)])).alias("c")).select("word", "n", "c.*")
    size = F.greatest(F.lit(1), F.least(F.lit(CELL_WORDS), F.floor(F.lit(CELL_POINTS) / F.greatest(F.col("m"), F.lit(1))))).cast("long")
    large = (every.groupBy("cell", "m").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > size)
             .select("cell", "m", F.ceil(F.col("words") / size).cast("int").alias("blocks")))
    dealt = every.join(large, ["cell", "m"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = (dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(F.xxhash64("cell", "m", i, j).alias("tile"), "word", "n", "m", "family", "role",
                        F.when(i == j, 0).when(F.col("own") == i, 1).otherwise(2).alias("side"))


def _points(words: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Padded code points of words of at most ``width``, forwards and backwards."""
    n = len(words)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(flat) or flat.max() < 256:
        flat = flat.astype(np.uint8)
    inside = np.arange(width)[None] < length[:, None]
    ahead = np.zeros((n, width), flat.dtype)
    ahead[inside] = flat
    back = np.zeros_like(ahead)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    back[np.repeat(np.arange(n), length), np.repeat(length, length) - 1 - place] = flat
    return ahead, back


def _shared(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Length of the common beginning, ``m`` at most, of every row of ``a`` with every row of ``b``."""
    out = np.zeros((len(a), len(b)), np.int32)
    run = np.ones((len(a), len(b)), bool)
    for k in range(m):
        run &= a[:, k, None] == b[None, :, k]
        if not run.any():
            break
        out += run
    return out


def _near_in_cells(rows: pa.Table, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of near words among rows of one ``m``, sorted by ``tile``."""
    ahead, back = _points(rows.column("word").combine_chunks(), m + 1)
    tile, family, role, side = (rows.column(c).to_numpy() for c in ("tile", "family", "role", "side"))
    half = m // 2
    for first in range(0, len(tile), TILE):
        a = slice(first, min(first + TILE, len(tile)))
        end = int(np.searchsorted(tile, tile[a.stop - 1], "right"))
        for second in range(first, end, TILE):
            b = slice(second, min(second + TILE, end))
            meet = tile[a, None] == tile[None, b]
            meet &= (role[a, None] + role[None, b]) < 2
            meet &= (side[a, None] != side[None, b]) | (side[a, None] == 0)
            if first == second:
                meet &= np.arange(a.stop - first)[:, None] < np.arange(b.stop - second)[None]
            if not meet.any():
                continue
            prefix = _shared(ahead[a], ahead[b], m)
            meet &= (prefix >= half) == (family[a, None] == 0)
            if not meet.any():
                continue
            longer = m + (role[a, None] | role[None, b])
            meet &= prefix + _shared(back[a], back[b], m) >= longer - 1
            i, j = np.nonzero(meet)
            if len(i):
                yield i + first, j + second


def near_words(counts: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: each pair of near words of ``(word, n)`` once. Words must be distinct, and should be a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "tile", STREAM_ROWS):
            table = table.sort_by([("m", "ascending"), ("tile", "ascending")])
            m = table.column("m").to_numpy()
            tile = table.column("tile").to_numpy()
            first = 0
            while first < len(m):  # rows of one m, whole cells, as many as their matrices allow
                end = int(np.searchsorted(m, m[first], "right"))
                most = first + max(1, CELL_POINTS // (int(m[first]) + 1))
                if end > most:
                    cut = np.flatnonzero(tile[first + 1:end] != tile[first:end - 1]) + first + 1
                    before, after = cut[cut <= most], cut[cut > most]
                    end = int(before[-1]) if len(before) else int(after[0]) if len(after) else end
                part = table.slice(first, end - first).combine_chunks()
                for i, j in _near_in_cells(part, int(m[first])):
                    i, j = pa.array(i), pa.array(j)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c).combine_chunks().take(k) for k in (i, j) for c in ("word", "n")], ["a", "n_a", "b", "n_b"])
                first = end

    # tasks by the rows that they compare, which are few bytes but much work
    tasks = max(1, -(-4 * counts.count() // STREAM_ROWS))
    return (_cells(counts).repartition(tasks, "tile").sortWithinPartitions("tile")
            .mapInArrow(run, "a string, n_a long, b string, n_b long"))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the rows ``(word, form)``: the last word that following forms reaches."""
    now = stage(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(now.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        now = moved.select("word", "root")
        if not moved.where("moved").take(1):
            return now


def spelling_variants(counts: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """Per word of ``(word, n)``: ``form``, ``root``, ``n``, ``n_near``, ``form_n``; words must be distinct."""
    counts = stage(counts, "word-counts")
    pairs = near_words(counts).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("p")).select("p.*")
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    rows = counts.join(best, "word", "left")
    common = -F.col("best.less") >= ratio * F.col("n")
    rows = stage(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                             F.when(common, F.col("best.near")).alias("form"),
                             F.when(common, -F.col("best.less")).alias("form_n")), "word-forms")
    roots = _roots(rows.where(F.col("form").isNotNull()).select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_of_documents(docs: DataFrame) -> DataFrame:
    """Forms and roots of the words of all documents."""
    return spelling_variants(word_counts(planted_words(docs)))
