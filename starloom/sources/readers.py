"""Table readers.

The source of each table is a parameter: Parquet files (the default), or any
other Spark data source such as JDBC, where predicates (see ``sources.splits``) make the read parallel.
No rows are fetched to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, location: str, name: str, *, fmt: str = "parquet",
               options: Mapping[str, str] | None = None, predicates: Sequence[str] | None = None) -> DataFrame:
    """Read one table.

    ``parquet``/``orc``: ``location`` is a folder; the table is
    ``<location>/<name>.parquet`` when that exists, else ``<location>/<name>``.
    ``jdbc``: ``location`` is the JDBC URL and ``name`` the table name; each of ``predicates`` is read
    by a task of its own.
    Any other format is passed to ``spark.read.format(fmt)`` with the path.
    """
    reader = spark.read.options(**dict(options or {}))
    if fmt == "jdbc" and predicates:
        return spark.read.jdbc(location, name, predicates=list(predicates), properties=dict(options or {}))
    if fmt == "jdbc":
        return reader.format("jdbc").option("url", location).option("dbtable", name).load()
    path = f"{location.rstrip('/')}/{name}.{fmt}"
    if not path_exists(spark, path):
        plain = f"{location.rstrip('/')}/{name}"
        path = plain if path_exists(spark, plain) else path
    return reader.format(fmt).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_tables(spark: SparkSession, location: str, names: Iterable[str],
                **kwargs) -> dict[str, DataFrame]:
    return {n: read_table(spark, location, n, **kwargs) for n in names}
