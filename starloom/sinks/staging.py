"""Staging folders under ``spark.checkpoint.dir``.

Intermediate results that must be computed once (numbered rows of a
distributed key, the keyed order lines of a refresh) are written here as
Parquet. Every folder is recorded by the thread that made it, so that a job can
drop its own intermediates when it is finished with them and never those of
another job that runs at the same time.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.bounds import mark_rows
from starloom.config import ensure_checkpoint_dir

#: Intermediates and tables in Parquet are written with this codec, which takes less disk than Spark's default.
PARQUET_CODEC = "zstd"


class _Created(threading.local):
    def __init__(self):
        self.paths: list[str] = []


_created = _Created()


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared storage)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/starloom-staging/{label}-{uuid.uuid4().hex}"
    _created.paths.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage (a lost executor re-reads committed files instead of
    recomputing joins) and lets several plans share one computation.
    """
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path, compression=PARQUET_CODEC)
    return df.sparkSession.read.parquet(path)


def stage_counted(df: DataFrame, label: str) -> DataFrame:
    """``stage``, with the rows counted by the write itself and recorded on the result."""
    seen = Observation()
    out = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return mark_rows(out, int(seen.get.get("rows", 0)))


def staging_mark() -> int:
    """Position in the record of staging folders; pass to ``drop_staging``."""
    return len(_created.paths)


def drop_staging(spark: SparkSession, since: int = 0) -> int:
    """Delete the staging folders this thread made after mark ``since``.

    Only call this once no DataFrame that reads them is needed any more.
    Returns the number of folders deleted. Sessions without JVM access
    (Spark Connect) keep their folders.
    """
    paths = _created.paths[since:]
    del _created.paths[since:]
    try:
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
    except Exception:
        return 0
    deleted = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)
            deleted += 1
    return deleted
