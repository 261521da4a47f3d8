"""Session helpers.

The library itself never creates a session: every builder takes the caller's
``SparkSession``. ``local_session`` is for tests and ``bench.py`` only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "starloom") -> SparkSession:
    """A local[N] session tuned for the small scale factors used in tests."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="starloom-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    In order: the folder already given to ``setCheckpointDir``, then the
    setting ``spark.checkpoint.dir``. Where both are unset a scratch folder is
    made on a ``local`` master only (tests); on a cluster the driver's own disk
    is of no use to the executors, so a ``RuntimeError`` names the setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    in_use = sc.getCheckpointDir()
    if in_use:
        # Spark adds a folder named by a UUID below the one that was given; it
        # lies on the same shared storage and goes with the application.
        return in_use
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return configured
