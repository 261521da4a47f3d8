"""Least order tuples of a written table's files, by which a top-k opens few of them.

After a table is written, one scan of its order columns notes the least tuple and the rows of every file
in a small Parquet table (one row per file, never gathered as a whole). A reader lists the first files
by that tuple: the rows below the least tuple of the next file are complete, however the files overlap.
A table that is written in key order (``operators.keys.dense_key``) has files that hardly overlap, so the
first ``n`` rows lie in the first few.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Files that are listed on the driver, at most; a reader that needs more reads the whole table.
MOST_FILES = 1024


def _tuple(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def file_ranges(df: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """``file`` (its path below ``folder``), ``least`` (order tuple, NULLs first) and ``file_rows`` of the files of ``df``.

    ``folder`` is the name of the table's last folder. Rows are added up within tasks, so
    one row per file and task is shuffled. A file without rows is not listed.
    """
    file = F.substring_index(F.col("_metadata.file_path"), f"/{folder}/", -1)
    return (df.select(file.alias("file"), _tuple(order).alias("least"))
            .groupBy("file").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("file_rows")))


@dataclass(frozen=True)
class FileRanges:
    """The ``file_ranges`` of a table, their order columns, and how to read some of its files."""

    files: DataFrame
    order: tuple[str, ...]
    read: Callable[[list[str]], DataFrame]

    def first(self, most: int = MOST_FILES) -> list[Row]:
        """The first files by their least tuples, at most ``most + 1`` of them."""
        return self.files.orderBy("least", "file").limit(most + 1).collect()

    def below(self, bound: Row) -> Column:
        """Whether a row's order tuple is below ``bound``, the least tuple of a file."""
        kinds = self.files.schema["least"].dataType
        return _tuple(self.order) < F.struct(*[F.lit(bound[c]).cast(kinds[c].dataType).alias(c) for c in self.order])
