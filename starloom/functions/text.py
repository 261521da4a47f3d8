"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_names(first: Column | str, last: Column | str, sep: str = " ") -> Column:
    """``first + sep + last`` where a NULL part counts as an empty string.

    Spark's ``concat`` returns NULL when any input is NULL and ``concat_ws``
    drops the separator with the NULL; neither matches a NULL-as-empty concat.
    """
    first = F.col(first) if isinstance(first, str) else first
    last = F.col(last) if isinstance(last, str) else last
    return F.concat(F.coalesce(first, F.lit("")), F.lit(sep), F.coalesce(last, F.lit("")))


def char_length_over(col: Column | str, width: int) -> Column:
    """True when the value is longer than the declared width."""
    col = F.col(col) if isinstance(col, str) else col
    return F.length(col) > F.lit(width)
