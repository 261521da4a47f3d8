"""The manifest of a target folder, and small JSON records beside it.

Every run writes its tables to ``<target>/<table>/run_id=<run>``, where nobody looks for them,
and is published by one file, ``<target>/_manifests/<version>.json``, which names the run of all seven tables.
Readers take the manifest of the highest version and resolve every table through it, so they
see one run, whole, whatever is being written. The file is created under its final name only if that does not
exist (written aside, then renamed without overwriting), so of two runs that both
follow version ``n`` one becomes ``n + 1`` and the other fails: a conditional commit. On HDFS
that rename is atomic; object stores need a file system whose rename without overwrite is. Nothing else changes hands.

Runs leave records in ``<target>/_runs/<run>``: ``begin`` with the run's fingerprint and one for
every table it has finished, by which a restarted refresh takes them over.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from starloom.schemas import TARGET_TABLES, create_view_sql
from starloom.sinks.writer import Written

MANIFESTS = "_manifests"
RUNS = "_runs"
WORK = "_work"
RANGES = "_ranges"


class PublishConflict(RuntimeError):
    """Another run was published since this one began."""


@dataclass(frozen=True)
class Manifest:
    """A published run: its version (from 1), its id, and what was written of each table."""

    version: int
    run_id: str
    tables: dict[str, Written]


def table_path(target: str, table: str, run_id: str) -> str:
    return f"{target.rstrip('/')}/{table}/run_id={run_id}"


def ranges_path(target: str, table: str, run_id: str) -> str:
    """Where the least order tuples of the files of a run's table lie (see ``sinks.ranges``)."""
    return f"{target.rstrip('/')}/{RANGES}/{run_id}/{table}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, in order; none if it does not exist."""
    place, fs = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def put_if_absent(spark: SparkSession, path: str, record: dict) -> bool:
    """Create ``path`` with ``record`` as JSON in one step; False if it exists already, which leaves it as it is."""
    place, fs = _hadoop(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    out.write(json.dumps(record, sort_keys=True).encode())
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    aside, place = fs.makeQualified(aside), fs.makeQualified(place)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(aside, place, how)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def get_record(spark: SparkSession, path: str) -> dict | None:
    """The record at ``path``, or None."""
    place, fs = _hadoop(spark, path)
    if not fs.exists(place):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def current_manifest(spark: SparkSession, target: str) -> Manifest | None:
    """The manifest of the highest version, or None before the first run."""
    folder = f"{target.rstrip('/')}/{MANIFESTS}"
    names = [n for n in list_names(spark, folder) if n.endswith(".json")]
    if not names:
        return None
    found = get_record(spark, f"{folder}/{names[-1]}")
    return Manifest(found["version"], found["run_id"], {n: Written(**w) for n, w in found["tables"].items()})


def publish(spark: SparkSession, target: str, run_id: str, tables: dict[str, Written], *, after: int) -> Manifest:
    """Make a run the current one if version ``after`` (0: none) still is; else ``PublishConflict``."""
    manifest = Manifest(after + 1, run_id, tables)
    if not put_if_absent(spark, f"{target.rstrip('/')}/{MANIFESTS}/{manifest.version:012d}.json", asdict(manifest)):
        raise PublishConflict(f"version {manifest.version} of {target} was published by another run")
    return manifest


def record_path(target: str, run_id: str, name: str) -> str:
    return f"{target.rstrip('/')}/{RUNS}/{run_id}/{name}.json"


def unfinished_run(spark: SparkSession, target: str, fingerprint: str) -> str | None:
    """The newest run of this fingerprint that began and was not published, or None."""
    for run_id in reversed(list_names(spark, f"{target.rstrip('/')}/{RUNS}")):
        begin = get_record(spark, record_path(target, run_id, "begin"))
        if begin and begin["fingerprint"] == fingerprint and get_record(spark, record_path(target, run_id, "published")) is None:
            return run_id
    return None


def delete_folder(spark: SparkSession, path: str) -> None:
    place, fs = _hadoop(spark, path)
    fs.delete(place, True)


def expire_runs(spark: SparkSession, target: str, *, keep: int = 2) -> list[str]:
    """Delete the tables of published runs but the newest ``keep`` (readers of older ones must be done); the runs deleted.

    Manifests and records stay, so a version is never given twice.
    """
    if keep < 1:
        raise ValueError("the current run cannot be deleted")
    root = target.rstrip("/")
    versions = [n for n in list_names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]
    runs = [get_record(spark, f"{root}/{MANIFESTS}/{n}")["run_id"] for n in versions]
    old = [r for r in dict.fromkeys(runs) if r not in runs[-keep:]]
    for run_id in old:
        for table in TARGET_TABLES:
            delete_folder(spark, table_path(target, table, run_id))
        delete_folder(spark, f"{root}/{RANGES}/{run_id}")
    return old


def create_views(spark: SparkSession, target: str, database: str) -> list[str]:
    """Catalog views ``<database>.<table>`` of the current run, whichever it is when they are read.

    Each resolves the run through the manifests at query time, so all seven change over with the
    publishing file and are created only once. At least one run must be published, all
    with the same partition columns.
    """
    names = []
    for name, table in TARGET_TABLES.items():
        qualified = f"{database}.{name}"
        spark.sql(create_view_sql(table, qualified, f"{target.rstrip('/')}/{name}", f"{target.rstrip('/')}/{MANIFESTS}"))
        names.append(qualified)
    return names
