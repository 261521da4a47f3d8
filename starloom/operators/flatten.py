"""Snowflake flattening: follow foreign keys through lookup tables with inner joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.bounds import keep_rows
from starloom.operators.keys import small_lookup


@dataclass(frozen=True)
class Lookup:
    """One hop: join ``table`` where ``table.parent_key == <current frame>.child_key``.

    ``columns`` maps lookup columns to output names; only those are carried.
    ``small`` marks a lookup table with few rows (a city, brand or status
    list): it is broadcast after a size check instead of shuffling the large
    side onto a few hot keys.
    """

    table: DataFrame
    child_key: str
    parent_key: str
    columns: dict[str, str]
    small: bool = False


def flatten(base: DataFrame, hops: Sequence[Lookup]) -> DataFrame:
    """Chain inner joins from ``base`` through ``hops`` in order.

    A row whose key has no parent is dropped (inner-join semantics). Each
    lookup is projected to its key plus the requested columns before the
    join, so scans read only those columns. Lookups marked ``small`` are
    broadcast once their size is checked; for the others the planner decides
    from statistics and AQE re-plans from measured sizes.
    """
    out = base
    for i, hop in enumerate(hops):
        k = f"_fl_{i}"
        side = hop.table.select(F.col(hop.parent_key).alias(k),
                                *[F.col(src).alias(dst) for src, dst in hop.columns.items()])
        keep_rows(hop.table, side)
        if hop.small:
            side = small_lookup(side)
        out = out.join(side, F.col(hop.child_key) == F.col(k), "inner").drop(k)
    return out
