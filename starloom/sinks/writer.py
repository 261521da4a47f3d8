"""Table writer that conforms to the declared schema and counts and digests rows while writing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation

from starloom.schemas import Table, conform
from starloom.sinks.digest import digest_aggregates
from starloom.sinks.staging import PARQUET_CODEC


@dataclass(frozen=True)
class Written:
    """What a write saw: its rows and their digests (see ``sinks.digest``), as decimal text."""

    rows: int
    keys_digest: str
    rows_digest: str


def write_table(df: DataFrame, table: Table, path: str, *, fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> Written:
    """Write ``df`` (conformed to ``table``) to ``path``; return the rows written and their digests.

    They are ``Observation`` metrics gathered by the write job itself,
    so no second pass over the data is made. An empty frame writes an empty
    table with the right schema.

    With ``partition_by`` the rows are first range-partitioned on the
    partition columns followed by the primary key: each task then holds a
    contiguous run of partition values and writes few files, and a hot
    partition value (one very busy day) is split over several tasks by the
    key instead of landing in one.
    """
    obs = Observation(f"rows_{table.name}")
    out = conform(df, table)
    if partition_by:
        out = out.repartitionByRange(*partition_by, *table.primary_key)
    out = out.observe(obs, *digest_aggregates(table))
    writer = out.write.mode(mode).format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", PARQUET_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    seen = obs.get
    return Written(int(seen.get("row_count", 0)), str(seen.get("keys_digest", 0)), str(seen.get("rows_digest", 0)))
