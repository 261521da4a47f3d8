"""Vector code compression with per-dimension value dictionaries (operator 11).

A vector's components become integers ``floor(scale * x)`` and the vector is cut
into parts; each part is replaced by the index of its nearest codebook entry, and
the entries are refined in rounds of integer means.

The integers are written once, in blocks of rows, as dictionary codes: for each
dimension the distinct integers of the block, ordered, and each row's place among
them. To assign a block, the squared differences of every distinct integer of a
dimension to that dimension of all entries are tabulated; the distance of a row's
part is then a sum of table rows that its codes pick: gathers and adds, without a
multiplication per row. A task holds one block, its tables and the sums of its
parts. Only those sums (``entries`` times the dimension) reach the driver, added up by
Spark beforehand; the codebooks, of that same size, go to the tasks.

All arithmetic is exact. Where integers are too large for 64-bit distances, a
block is worked in Python integers by the same steps. An ``error`` beyond the
range of a long is given as the largest long, and so is a sum of them.

Rows: a null vector, or one with null or non-finite components, is dropped. Vectors
that have not the commonest number of components (ties: the smaller) have no code: ``codes``
and ``error`` are null, and they count nowhere. Where the parts cannot be equal the first ones
are one longer; with fewer components than parts the last parts are empty. Repeated
ids are separate rows, in the order of their vectors; null ids come last. A null label is a label
like any other. With fewer vectors than ``entries`` each one seeds an entry, and
an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.skew import join_per_key
from starloom.sinks.staging import stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: Rows of a block, and its components at most (a block has one row at least); places in a dictionary fit 16 bits.
BLOCK_ROWS = 4096
BLOCK_COMPONENTS = 1 << 22

_LONG_MAX = (1 << 63) - 1
_LIMB_BITS = 30
_BLOCK = "ids binary, labels binary, rows long, codes binary, dictionary binary, sizes binary"


@dataclass
class Codebooks:
    """``entries[p]`` has one row of integers for each entry of part ``p``."""

    entries: list[np.ndarray]

    @property
    def sha256(self) -> str:
        """Digest of all components as decimals, joined by commas, by part, entry and position."""
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for row in part for x in row).encode()).hexdigest()


@dataclass
class Compressed:
    """``rows``: id, label, ``codes`` (one index a part), ``error``; ``label_error``: of each label."""

    rows: DataFrame
    label_error: DataFrame
    codebooks: Codebooks


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles as 64-bit integers, or as Python integers where that is too narrow."""
    if not len(x) or np.abs(x).max() * scale < 1 << 53:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(len(x), object)
    for i, v in enumerate(x.tolist()):
        top, bottom = v.as_integer_ratio()
        out[i] = top * scale // bottom
    return out


def _bounds(dimension: int, parts: int) -> np.ndarray:
    """First component of each part, and the end."""
    size = np.full(parts, dimension // parts)
    size[:dimension % parts] += 1
    return np.concatenate([[0], np.cumsum(size)])


def _blocks(rows: DataFrame, dimension: int, scale: int) -> DataFrame:
    """Rows (``id``, ``label``, ``vector``) as blocks of dictionary codes.

    A dictionary holds integers over ``scale`` as doubles, which is exact for a power of two.
    """
    size = max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // max(1, dimension)))

    def packed(column: pa.Array) -> bytes:
        sink = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([column], ["x"])
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def block(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        x = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        small = np.abs(x) < 2.0 ** 53 / scale  # others are multiples of 1 / scale themselves
        x = np.where(small, np.floor(np.where(small, x, 0) * scale) / scale, x).reshape(n, dimension)
        values, sizes, codes = [], [], np.empty((dimension, n), np.uint16)
        for j in range(dimension):
            distinct, codes[j] = np.unique(x[:, j], return_inverse=True)
            values.append(distinct)
            sizes.append(len(distinct))
        return pa.RecordBatch.from_pydict({
            "ids": [packed(table.column("id").combine_chunks())], "labels": [packed(table.column("label").combine_chunks())],
            "rows": [n], "codes": [codes.tobytes()], "dictionary": [np.concatenate([np.zeros(0), *values]).tobytes()],
            "sizes": [np.array(sizes, np.int32).tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                table = pa.Table.from_batches(held)
                while n >= size:
                    yield block(table.slice(0, size))
                    table, n = table.slice(size), n - size
                held = table.to_batches()
        if n:
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(run, _BLOCK)


def _column(packed: bytes) -> pa.Array:
    return pa.ipc.open_stream(packed).read_all().column("x").combine_chunks()


def _assigned(row: dict, books: list[np.ndarray], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part of a block: index of the nearest entry, its squared distance, and the part's integers."""
    n = row["rows"]
    sizes = np.frombuffer(row["sizes"], np.int32)
    codes = np.frombuffer(row["codes"], np.uint16).reshape(len(sizes), n)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    values = _integers(np.frombuffer(row["dictionary"], np.float64), scale)
    largest = max([int(np.abs(values).max(initial=0))] + [int(np.abs(b).max(initial=0)) for b in books])
    at = 0
    for book in books:
        width = book.shape[1]
        most = width * (2 * largest) ** 2
        kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
        distance = np.zeros((n, len(book)), kind)
        picked = np.empty_like(distance)
        integers = np.zeros((n, width), values.dtype)
        for j in range(width):
            of_dimension = values[starts[at + j]:starts[at + j + 1]]
            table = of_dimension.astype(kind)[:, None] - book[:, j].astype(kind)[None]
            table *= table
            np.take(table, codes[at + j], axis=0, out=picked, mode="clip")
            distance += picked
            integers[:, j] = of_dimension[codes[at + j]]
        nearest = distance.argmin(1)
        yield nearest, distance[np.arange(n), nearest], integers
        at += width


def _sums(blocks: DataFrame, books: list[np.ndarray], scale: int) -> dict[tuple[int, int, int], int]:
    """Exact ``{(part, entry, position): sum}`` over the assigned parts; position -1 has their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for row in batch.to_pylist():
                for p, (nearest, _, integers) in enumerate(_assigned(row, books, scale)):
                    if integers.dtype == object and sums[p].dtype != object:
                        sums[p] = sums[p].astype(object)
                    np.add.at(sums[p][:, 1:], nearest, integers)
                    np.add.at(sums[p][:, 0], nearest, 1)
        for p, part in enumerate(sums):
            entry, at = np.nonzero(part)
            value, limb = part[entry, at], 0
            while len(entry):
                low, value = value & ((1 << _LIMB_BITS) - 1), value >> _LIMB_BITS
                last = (value == 0) | (value == -1)  # what remains is a sign, which the last limb takes
                low = np.where(last, low + (value << _LIMB_BITS), low).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(entry), p, np.int32)), pa.array(entry.astype(np.int32)), pa.array((at - 1).astype(np.int32)),
                     pa.array(np.full(len(entry), limb, np.int32)), pa.array(low)], ["part", "entry", "at", "limb", "value"])
                entry, at, value, limb = entry[~last], at[~last], value[~last], limb + 1

    parts = blocks.mapInArrow(run, "part int, entry int, at int, limb int, value long")
    out: dict[tuple[int, int, int], int] = {}
    for r in parts.groupBy("part", "entry", "at", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r["part"], r["entry"], r["at"])
        out[key] = out.get(key, 0) + (r["value"] << (_LIMB_BITS * r["limb"]))
    return out


def _refined(books: list[np.ndarray], sums: dict[tuple[int, int, int], int]) -> list[np.ndarray]:
    """Entries replaced by the rounded-down means of their parts; unused ones stay."""
    out = []
    for p, book in enumerate(books):
        rows = [[sums.get((p, e, j), 0) // sums[p, e, -1] for j in range(book.shape[1])] if (p, e, -1) in sums
                else [int(x) for x in book[e]] for e in range(len(book))]
        out.append(_book(rows, book.shape[1]))
    return out


def _book(rows: list[list[int]], width: int) -> np.ndarray:
    small = all(abs(x) < 1 << 53 for row in rows for x in row)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), width)


def _seeds(rows: DataFrame, entries: int, parts: int, scale: int, dimension: int) -> list[np.ndarray]:
    """Parts of the vectors with the smallest ids.

    The ids alone are ordered first; the vectors are then read under the last of them.
    """
    ids = [r["id"] for r in rows.where(F.col("id").isNotNull()).select("id").orderBy("id").limit(entries).collect()]
    if len(ids) == entries:
        rows = rows.where(F.col("id") <= F.lit(ids[-1]))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = [[int(v) for v in _integers(np.array(r["vector"], np.float64), scale)] for r in first]
    cut = _bounds(dimension, parts)
    return [_book([row[a:b] for row in whole], int(b - a)) for a, b in zip(cut[:-1], cut[1:])]


def _coded(blocks: DataFrame, books: list[np.ndarray], scale: int, id_type: T.DataType, label_type: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type),
                           T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, errors = [], np.zeros(row["rows"], object)
                for nearest, distance, _ in _assigned(row, books, scale):
                    codes.append(nearest.astype(np.int32))
                    errors += distance.astype(object)
                errors = np.array([min(int(e), _LONG_MAX) for e in errors], np.int64)
                flat = pa.array(np.stack(codes, 1).ravel())
                ends = pa.array(np.arange(row["rows"] + 1, dtype=np.int32) * len(books))
                yield pa.RecordBatch.from_arrays(
                    [_column(row["ids"]), _column(row["labels"]), pa.ListArray.from_arrays(ends, flat), pa.array(errors)],
                    ["id", "label", "codes", "error"])

    return blocks.mapInArrow(run, schema)


def compress_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codebooks fitted to the vectors, and every kept vector's codes and error."""
    if not 0 < entries <= 1 << 16 or scale < 1 or scale & (scale - 1):
        raise ValueError("entries must lie between 1 and 65536, and scale must be a power of two")
    kept = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")))
    common = (kept.groupBy(F.size("vector").alias("d")).count()
              .orderBy(F.desc("count"), "d").limit(1).collect())
    dimension = common[0]["d"] if common else 0
    rows = kept.where(F.size("vector") == dimension)
    blocks = stage(_blocks(rows, dimension, scale), "vector-blocks")
    books = _seeds(rows, entries, parts, scale, dimension)
    for _ in range(rounds if len(books[0]) else 0):
        books = _refined(books, _sums(blocks, books, scale))
    coded = _coded(blocks, books, scale, kept.schema["id"].dataType, kept.schema["label"].dataType)
    others = kept.where(F.size("vector") != dimension).select(
        "id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
    coded = stage(coded.unionByName(others), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    per_label = coded.groupBy("label").agg(F.least(total, F.lit(_LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return Compressed(coded, per_label, Codebooks(books))


def compressed_codes(df: DataFrame) -> DataFrame:
    """Per kept vector: ``vec_id``, ``code`` in hex, ``error``, ``label_error``, ``codebooks_sha256``."""
    done = compress_vectors(df)
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("key")
    rows = done.rows.select("id", "codes", "error", key)
    joined = join_per_key(rows, done.label_error.select(key, "label_error"), "key")
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return joined.select(F.col("id").alias("vec_id"), F.when(F.col("codes").isNotNull(), F.concat_ws("", digits)).alias("code"),
                         "error", "label_error", F.lit(done.codebooks.sha256).alias("codebooks_sha256"))
