"""Counted rows carried on DataFrame objects.

When a write has counted a table's rows (or a calendar of n days is built), the number is
recorded on the frame, and on projections of it, so that later decisions (broadcast a
lookup, compare key counts) know it without a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_ATTR = "_starloom_rows"


def mark_rows(df: DataFrame, rows: int) -> DataFrame:
    """Record on ``df`` that it has exactly ``rows`` rows."""
    setattr(df, _ATTR, rows)
    return df


def known_rows_exactly(df: DataFrame) -> int | None:
    """The number recorded by ``mark_rows``, if any."""
    return getattr(df, _ATTR, None)


def keep_rows(source: DataFrame, derived: DataFrame) -> DataFrame:
    """Carry ``source``'s number to ``derived``, a projection of it."""
    rows = known_rows_exactly(source)
    return mark_rows(derived, rows) if rows is not None else derived
