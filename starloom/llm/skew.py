"""Joins whose key may hold most rows in a few values, and sorted streams of whole groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A value of the key is heavy when it holds more than one in so many rows; so there are fewer heavy values than that.
HEAVY_SHARE = 1000


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined to ``per_key``, which has one row for each value of ``key``.

    The heavy values (fewer than ``HEAVY_SHARE``, by their definition) are joined as a
    broadcast, where their rows lie; only the rows of the other values are shuffled.
    ``rows`` is read three times and should be a written table. Null keys match nothing.
    """
    sizes = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = rows.count()
    heavy = F.broadcast(sizes.where(F.col("_rows") * HEAVY_SHARE > total).select(key))
    known = F.broadcast(per_key.join(heavy, key, "left_semi"))
    return rows.join(known, key).unionByName(rows.join(heavy, key, "left_anti").join(per_key, key, "left"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups of ``key`` (a long) from batches in which equal keys lie together.

    A table has about ``rows`` rows, or those of one larger group.
    """
    held: list[pa.RecordBatch] = []
    n, wanted = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < wanted:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), n - cut
        wanted = max(rows, 2 * n)
    if n:
        yield pa.Table.from_batches(held)
