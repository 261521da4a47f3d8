"""The normalised retail source model as a bundle of DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import DATE, SOURCE_TABLES, Table, conform
from starloom.sources.readers import read_table

TableSpec = DataFrame | Callable[[], DataFrame]


class RetailSource:
    """The twelve source tables, by attribute (``src.customer``, ``src.sales_order`` ...).

    A table may be given as a DataFrame or as a zero-argument function that
    builds one; functions run on first access only, so work that has an eager
    step (such as a checkpointed key) is done only for tables a plan uses.

    ``ship_date`` may be carried by ``sales_order`` (one date per order) or by
    ``sales_order_line`` (one per line); the fact builders take it from
    whichever table has it.
    """

    NAMES = tuple(SOURCE_TABLES)

    def __init__(self, tables: Mapping[str, TableSpec] | None = None, **kwargs: TableSpec):
        specs = dict(tables or {}, **kwargs)
        missing = [n for n in self.NAMES if n not in specs]
        if missing:
            raise ValueError(f"missing source tables: {missing}")
        self._specs = {n: specs[n] for n in self.NAMES}
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            spec = self._specs[name]
            self._built[name] = spec if isinstance(spec, DataFrame) else spec()
        return self._built[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in RetailSource.NAMES:
            raise AttributeError(name)
        return self.table(name)

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in self.NAMES}


def conform_source(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with the columns that the source model declares, by name and of the declared types.

    A value that does not fit its type raises (ANSI casts): dates given as strings and wider decimals
    are taken if they can be. Other columns are left out, and a missing one raises, but for ``ship_date``, which may be
    with the orders or with their lines.
    """
    by_line = table.name == "sales_order_line" and "ship_date" in df.columns
    if table.name == "sales_order" and "ship_date" not in df.columns:
        df = df.withColumn("ship_date", F.lit(None).cast(DATE))
        return conform(df, table).drop("ship_date")
    out = conform(df, table)
    return out if not by_line else df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields],
                                             F.col("ship_date").cast(DATE).alias("ship_date"))


def read_retail_source(spark: SparkSession, location: str, *, fmt: str = "parquet",
                       options: Mapping[str, str] | None = None,
                       splits: Mapping[str, Sequence[str]] | None = None) -> RetailSource:
    """Read the twelve tables by name from ``location`` (folder or JDBC URL), each as the model declares it.

    ``splits`` has the predicates by which a JDBC table is read in parallel, by table
    name (``sources.splits``); a table without any is read by one task.
    """
    def read(name: str) -> DataFrame:
        df = read_table(spark, location, name, fmt=fmt, options=options, predicates=(splits or {}).get(name))
        return conform_source(df, SOURCE_TABLES[name])

    return RetailSource({name: read(name) for name in SOURCE_TABLES})
