"""Type-2 versioning columns for dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def initial_version(df: DataFrame, effective_from: dt.date | str) -> DataFrame:
    """Add ``effective_from``, ``effective_to`` (NULL = open) and ``is_current = 1``.

    A full refresh writes every row as its first, current version; no change
    detection takes place.
    """
    return df.select(
        "*",
        F.lit(effective_from).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(1).cast("smallint").alias("is_current"),
    )
