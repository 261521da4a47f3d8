"""Order-free digests of a table's rows.

A row's hash is the first 60 bits of the MD5 of its values as text; a table's digest is the sum of
these over its rows. Sums do not depend on the order or the partitioning of the rows, so they are gathered
while a table is written and compared when it is read; repeated rows count each time.
Two column groups are digested: the keys (primary and foreign keys), which tell whether rows are linked alike, and whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.schemas import Table

#: Fixed values of the digest: what parts the values of a row, and what stands for NULL.
SEPARATOR = "\x1f"
NULL_TEXT = "\\N"
HEX_DIGITS = 15
#: A hash is added up in parts of so many bits, as whole numbers, which hold the sums of 2 ** 43 rows.
PART_BITS = 20


def column_groups(table: Table) -> dict[str, list[str]]:
    """The digested column groups: ``keys_digest`` and ``rows_digest``."""
    linked = [*table.primary_key, *(c for cols, _, _ in table.foreign_keys for c in cols)]
    return {"keys_digest": [c for c in table.columns if c in linked], "rows_digest": table.columns}


def row_hash(cols: Sequence[str]) -> Column:
    """The hash of a row as a long of 60 bits."""
    text = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("long")


def hash_sum(hashes: Column) -> Column:
    """The exact sum of 60-bit hashes as a decimal; decimals are made once, not for every row."""
    parts = [F.sum(F.shiftright(hashes, k * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1))).cast("decimal(38,0)")
             * F.lit(1 << k * PART_BITS).cast("decimal(13,0)") for k in range(4 * HEX_DIGITS // PART_BITS)]
    return F.coalesce(sum(parts[1:], parts[0]), F.lit(0)).cast("decimal(38,0)")


def digest_aggregates(table: Table) -> list[Column]:
    """``row_count`` and the digests of ``table``, as aggregates over its conformed rows."""
    sums = [hash_sum(row_hash(cols)).alias(name)
            for name, cols in column_groups(table).items()]
    return [F.count(F.lit(1)).alias("row_count"), *sums]


def table_digest(df: DataFrame, table: Table) -> DataFrame:
    """One row: ``table_name``, ``row_count``, ``keys_digest``, ``rows_digest``."""
    return df.agg(*digest_aggregates(table)).select(F.lit(table.name).alias("table_name"), "*")
