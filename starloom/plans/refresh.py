"""Full refresh of the star schema.

A refresh builds all seven tables in load order (dimensions, then the line fact, then the
snapshot), each under its run's own folder, and publishes them together by one
manifest (``sinks.manifest``). Until then readers see the run before, afterwards this one.

Each finished table is recorded with its rows and digests. A refresh that finds an unpublished run
of the same fingerprint - source, arguments and plans alike - takes over what that run has recorded and builds only
the rest. The "keyed lines" that fact and snapshot share are such a recorded part: they
are written once into the run's work folder, which is deleted when the run is published.

All facts and lookups read the written dimensions, whose row counts are known.
The ranges of the fact's files by the report's order are written beside each run
(``sinks.ranges``), so ``run_report`` opens few of them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.bounds import mark_rows
from starloom.config import ensure_checkpoint_dir
from starloom.plans.calendar import calendar_covering, calendar_dimension
from starloom.plans.dimensions import (
    customer_dimension,
    geography_dimension,
    order_status_dimension,
    product_dimension,
)
from starloom.plans.facts import keyed_lines, sales_fact
from starloom.plans.report import REPORT_ORDER, sales_report
from starloom.plans.snapshot import sales_monthly_snapshot
from starloom.schemas import LOAD_ORDER, TARGET_TABLES, conform, create_table_sql
from starloom.sinks.digest import table_digest
from starloom.sinks.manifest import (
    WORK,
    Manifest,
    current_manifest,
    delete_folder,
    get_record,
    list_names,
    publish,
    put_if_absent,
    ranges_path,
    record_path,
    table_path,
    unfinished_run,
)
from starloom.sinks.ranges import FileRanges, file_ranges
from starloom.sinks.staging import PARQUET_CODEC, drop_staging, staging_mark
from starloom.sinks.writer import Written, write_table
from starloom.sources.retail import RetailSource

#: Part of every fingerprint; to be raised when a plan changes what it computes.
PLAN_VERSION = 1


def _ship_dates(src: RetailSource) -> DataFrame:
    if "ship_date" in src.sales_order.columns:
        return src.sales_order.select(F.col("ship_date").alias("d"))
    return src.sales_order_line.select(F.col("ship_date").alias("d"))


def source_fingerprint(spark: SparkSession, src: RetailSource) -> str | None:
    """Digest of the paths, lengths and times of the source's files; None if a table does not lie in files of its own.

    Only file metadata is read, by Spark's tasks; the contents are not.
    """
    tables = src.tables()
    files = {name: df.inputFiles() for name, df in tables.items()}
    scratch = ensure_checkpoint_dir(spark).split(":", 1)[-1].rstrip("/")
    if any(not f or any(scratch in p for p in f) for f in files.values()):
        return None
    listed = (spark.read.format("binaryFile").load(sorted({p for f in files.values() for p in f}))
              .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"), "length"))
    row = listed.agg(F.count(F.lit(1)), F.sum("length"), F.sum("h")).first()
    return "/".join(str(x) for x in row)


def _fingerprint(source: str | None, **arguments: object) -> str:
    """One for every state of the source and every choice that decides the rows; never the same without a source version."""
    ddl = [create_table_sql(t, t.name) for t in TARGET_TABLES.values()]
    state = [PLAN_VERSION, source or uuid.uuid4().hex, ddl, {k: str(v) for k, v in sorted(arguments.items())}]
    return hashlib.sha256(json.dumps(state).encode()).hexdigest()


def full_refresh(spark: SparkSession, src: RetailSource, target: str, *,
                 as_of: dt.date, calendar: tuple[dt.date, dt.date] | None = None,
                 fmt: str = "parquet", fact_partition_by: tuple[str, ...] = (),
                 source_version: str | None = None, resume: bool = True) -> DataFrame:
    """Rebuild all seven tables as a new run of ``target`` and publish it; return the load report.

    ``calendar`` gives the calendar's first and last day; by default it covers
    the whole years of every order and ship date. The report has one row per
    table: ``run_id``, ``load_order``, ``table_name``, ``rows_written``.

    With ``resume`` an unpublished run of the same fingerprint is taken over. The source's state in it is
    ``source_version``, or else that of its files (``source_fingerprint``); a source with neither is
    rebuilt. One refresh of a target runs at a time; if another was published meanwhile, ``PublishConflict`` is
    raised and the finished tables stay recorded.
    """
    # Build the source tables first (some have staged parts of their own), so
    # that only this refresh's intermediates are dropped at the end.
    src.tables()
    before = current_manifest(spark, target)
    mark = staging_mark()
    state = source_version or (source_fingerprint(spark, src) if resume else None)
    fingerprint = _fingerprint(state, as_of=as_of, calendar=calendar, fmt=fmt, fact_partition_by=fact_partition_by)
    run_id = unfinished_run(spark, target, fingerprint) if resume else None
    if run_id is None:
        run_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
        put_if_absent(spark, record_path(target, run_id, "begin"), {"fingerprint": fingerprint})
    written: dict[str, Written] = {}

    def load(name: str, build: Callable[[], DataFrame], **kw) -> DataFrame:
        path = table_path(target, name, run_id)
        done = get_record(spark, record_path(target, run_id, name))
        if done is None:
            done = asdict(write_table(build(), TARGET_TABLES[name], path, fmt=fmt, **kw))
            put_if_absent(spark, record_path(target, run_id, name), done)
        written[name] = Written(**done)
        return mark_rows(conform(spark.read.format(fmt).load(path), TARGET_TABLES[name]), written[name].rows)

    def dim_date() -> DataFrame:
        if calendar is not None:
            return calendar_dimension(spark, *calendar)
        dates = src.sales_order.select(F.col("order_date").alias("d")).unionByName(_ship_dates(src))
        return calendar_covering(F.col("d"), source=dates)

    work = f"{target.rstrip('/')}/{WORK}/{run_id}"

    def lines() -> DataFrame:
        path = f"{work}/keyed_lines"
        if get_record(spark, record_path(target, run_id, "keyed_lines")) is None:
            keyed_lines(src, customers, products, geography).write.mode("overwrite").parquet(path, compression=PARQUET_CODEC)
            put_if_absent(spark, record_path(target, run_id, "keyed_lines"), {"path": path})
        return spark.read.parquet(path)

    try:
        load("dim_date", dim_date)
        customers = load("dim_customer", lambda: customer_dimension(src, as_of))
        products = load("dim_product", lambda: product_dimension(src))
        geography = load("dim_geography", lambda: geography_dimension(src))
        statuses = load("dim_order_status", lambda: order_status_dimension(src))
        load("fact_sales", lambda: sales_fact(lines(), statuses), partition_by=fact_partition_by)
        if get_record(spark, record_path(target, run_id, "fact_ranges")) is None:
            ranges = file_ranges(spark.read.format(fmt).load(table_path(target, "fact_sales", run_id)), REPORT_ORDER, f"run_id={run_id}")
            place = ranges_path(target, "fact_sales", run_id)
            ranges.write.mode("overwrite").parquet(place)
            put_if_absent(spark, record_path(target, run_id, "fact_ranges"), {"path": place})
        load("fact_sales_monthly_snapshot", lambda: sales_monthly_snapshot(lines()))
        manifest = publish(spark, target, run_id, written, after=before.version if before else 0)
        put_if_absent(spark, record_path(target, run_id, "published"), {"version": manifest.version})
        delete_folder(spark, work)
    finally:
        # Committed or failed: what was staged for steps of this run is not needed.
        drop_staging(spark, mark)
    return load_report(spark, manifest)


def load_report(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """One row per table: ``run_id``, ``load_order``, ``table_name``, ``rows_written``."""
    return spark.createDataFrame(
        [(manifest.run_id, i + 1, name, manifest.tables[name].rows) for i, name in enumerate(LOAD_ORDER)],
        "run_id string, load_order int, table_name string, rows_written long")


def read_run(spark: SparkSession, target: str, manifest: Manifest, *, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The seven tables of a published run, columns in declared order, rows known from the manifest.

    (A partitioned table reads back with its partition columns last and their
    types inferred from folder names; ``conform`` restores both.)
    """
    return {name: mark_rows(conform(spark.read.format(fmt).load(table_path(target, name, manifest.run_id)), TARGET_TABLES[name]),
                            manifest.tables[name].rows) for name in LOAD_ORDER}


def read_star(spark: SparkSession, target: str, *, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The seven tables of the current run, all resolved through one manifest."""
    manifest = current_manifest(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"no run published under {target}")
    return read_run(spark, target, manifest, fmt=fmt)


def fact_ranges(spark: SparkSession, target: str, manifest: Manifest, *, fmt: str = "parquet") -> FileRanges | None:
    """The ranges of the files of a run's fact; None if it was written without."""
    place = ranges_path(target, "fact_sales", manifest.run_id)
    if not list_names(spark, place):
        return None
    root = table_path(target, "fact_sales", manifest.run_id)

    def read(files: list[str]) -> DataFrame:
        some = spark.read.format(fmt).option("basePath", root).load([f"{root}/{f}" for f in files])
        return conform(some, TARGET_TABLES["fact_sales"])

    return FileRanges(spark.read.parquet(place), REPORT_ORDER, read)


def run_report(spark: SparkSession, target: str, *, n: int = 100, fmt: str = "parquet") -> DataFrame:
    """The report's first ``n`` lines over the current run; only the first files of its fact are opened."""
    manifest = current_manifest(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"no run published under {target}")
    star = read_run(spark, target, manifest, fmt=fmt)
    return sales_report(star["fact_sales"], star["dim_date"], star["dim_customer"], star["dim_product"], star["dim_geography"],
                        star["dim_order_status"], n=n, files=fact_ranges(spark, target, manifest, fmt=fmt))


def run_digests(spark: SparkSession, target: str, manifest: Manifest, *, fmt: str = "parquet") -> DataFrame:
    """Rows and digests of the tables as they lie there, beside those of the write.

    ``table_name``, ``row_count``, ``keys_digest``, ``rows_digest`` and ``as_written`` (whether all
    three equal what the write saw); one scan of each table.
    """
    out = None
    for name, df in read_run(spark, target, manifest, fmt=fmt).items():
        w = manifest.tables[name]
        same = ((F.col("row_count") == w.rows) & (F.col("keys_digest") == F.lit(w.keys_digest).cast("decimal(38,0)"))
                & (F.col("rows_digest") == F.lit(w.rows_digest).cast("decimal(38,0)")))
        part = table_digest(df, TARGET_TABLES[name]).withColumn("as_written", same)
        out = part if out is None else out.unionByName(part)
    return out


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose the star as temporary views (``<prefix><table>``) for ``spark.sql``."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
