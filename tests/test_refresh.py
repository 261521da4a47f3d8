import datetime as dt

import pytest

from starloom.plans import refresh
from starloom.plans.refresh import full_refresh, read_run, read_star, run_digests
from starloom.schemas import LOAD_ORDER, TARGET_TABLES
from starloom.sinks import manifest as manifests
from starloom.sinks.manifest import (
    Manifest,
    PublishConflict,
    create_views,
    current_manifest,
    expire_runs,
    list_names,
    publish,
    put_if_absent,
    record_path,
    table_path,
)
from starloom.sinks.staging import staging_path
from starloom.sinks.writer import Written
from starloom.sources.retail import read_retail_source
from tests.fixtures import retail_fixture

AS_OF = dt.date(2024, 12, 31)


def _rows(star):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in star.items()}


@pytest.fixture()
def source(spark, tmp_path):
    """The fixture as written files, whose state has a fingerprint."""
    place = str(tmp_path / "source")
    for name, df in retail_fixture(spark).tables().items():
        df.write.parquet(f"{place}/{name}")
    return place


def test_full_refresh_writes_all_tables_and_report(spark):
    src = retail_fixture(spark)
    target = staging_path(spark, "refresh-test")
    report = {r.table_name: r.rows_written for r in
              full_refresh(spark, src, target, as_of=AS_OF,
                           calendar=(dt.date(2023, 1, 1), dt.date(2024, 12, 31))).collect()}
    assert report == {"dim_date": 731, "dim_customer": 3, "dim_product": 2,
                      "dim_geography": 3, "dim_order_status": 2, "fact_sales": 5,
                      "fact_sales_monthly_snapshot": 3}
    star = read_star(spark, target)
    for name, df in star.items():
        assert df.columns == TARGET_TABLES[name].columns
        assert df.count() == report[name]
    assert list_names(spark, f"{target}/_work") == []


def test_a_run_that_is_not_published_is_not_visible(spark):
    src = retail_fixture(spark)
    target = staging_path(spark, "refresh-test")
    assert current_manifest(spark, target) is None
    with pytest.raises(FileNotFoundError):
        read_star(spark, target)
    full_refresh(spark, src, target, as_of=AS_OF)
    done = current_manifest(spark, target)
    spark.range(1).write.parquet(table_path(target, "dim_date", "99999999T999999-broken"))
    assert current_manifest(spark, target) == done and done.version == 1


def test_a_reader_between_any_two_steps_sees_one_run(spark, monkeypatch):
    """By folder and by catalog views: before, during and after the second run all seven tables are of one run."""
    target = staging_path(spark, "refresh-test")
    full_refresh(spark, retail_fixture(spark), target, as_of=AS_OF)
    first = current_manifest(spark, target).run_id
    db = staging_path(spark, "catalog-db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS starloom_steps LOCATION '{db}'")
    create_views(spark, target, "starloom_steps")
    fewer = retail_fixture(spark, customers=[(1, "Ada", "Lane", "ada@example.org", None, None, 1000, dt.datetime(2021, 1, 1))])
    sizes = {3: [3, 5, 3], 1: [1, 3, 1]}
    seen = []

    def look():
        by_path = read_star(spark, target)
        by_path = [by_path[n].count() for n in ("dim_customer", "fact_sales", "fact_sales_monthly_snapshot")]
        by_view = [spark.table(f"starloom_steps.{n}").count() for n in ("dim_customer", "fact_sales", "fact_sales_monthly_snapshot")]
        assert by_path == by_view and by_path in sizes.values()
        seen.append((current_manifest(spark, target).run_id, by_path[0]))

    def between(step):
        def run(*args, **kw):
            look()
            out = step(*args, **kw)
            look()
            return out
        return run

    for module, name in ((refresh, "write_table"), (refresh, "publish"), (refresh, "put_if_absent"), (refresh, "delete_folder"),
                         (manifests, "put_if_absent")):
        monkeypatch.setattr(module, name, between(getattr(module, name)))
    full_refresh(spark, fewer, target, as_of=AS_OF)
    second = current_manifest(spark, target).run_id
    assert set(seen) == {(first, 3), (second, 1)} and sorted(seen, key=lambda s: s[0] != first) == seen
    assert spark.table("starloom_steps.dim_customer").schema == read_star(spark, target)["dim_customer"].schema
    joined = spark.sql("SELECT count(*) FROM starloom_steps.fact_sales f JOIN starloom_steps.dim_order_status s "
                       "ON s.order_status_key = f.order_status_key WHERE s.order_status = 'Open'").first()[0]
    assert joined == 1


def test_publishing_is_conditional(spark):
    target = staging_path(spark, "refresh-test")
    tables = {n: Written(0, "0", "0") for n in LOAD_ORDER}
    assert publish(spark, target, "a", tables, after=0).version == 1
    with pytest.raises(PublishConflict):
        publish(spark, target, "b", tables, after=0)
    assert publish(spark, target, "c", tables, after=1).version == 2
    assert current_manifest(spark, target) == Manifest(2, "c", tables)
    place = f"{target}/record.json"
    assert put_if_absent(spark, place, {"x": 1}) and not put_if_absent(spark, place, {"x": 2})
    assert manifests.get_record(spark, place) == {"x": 1} and "_manifests" in list_names(spark, target)
    assert not [n for n in list_names(spark, target) if n.endswith(".tmp")]


def test_a_run_overtaken_by_another_fails_and_can_be_taken_over(spark, source, monkeypatch):
    target = staging_path(spark, "refresh-test")
    real = refresh.publish
    monkeypatch.setattr(refresh, "publish", lambda *a, **kw: (real(spark, target, "other", a[3], after=0), real(*a, **kw))[1])
    with pytest.raises(PublishConflict):
        full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF)
    assert current_manifest(spark, target).run_id == "other"
    monkeypatch.setattr(refresh, "publish", real)
    monkeypatch.setattr(refresh, "write_table", None)  # nothing is written again
    full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF)
    assert current_manifest(spark, target).version == 2 and read_star(spark, target)["fact_sales"].count() == 5


@pytest.mark.parametrize("last", ["dim_product", "fact_sales"])
def test_a_killed_run_is_finished_without_building_again(spark, source, monkeypatch, last):
    target, whole = staging_path(spark, "refresh-test"), staging_path(spark, "refresh-whole")
    full_refresh(spark, read_retail_source(spark, source), whole, as_of=AS_OF)
    real = refresh.write_table

    def until(df, table, path, **kw):
        if LOAD_ORDER.index(table.name) > LOAD_ORDER.index(last):
            df.limit(1).write.parquet(path)  # a part of the next table is there already
            raise KeyboardInterrupt
        return real(df, table, path, **kw)

    monkeypatch.setattr(refresh, "write_table", until)
    with pytest.raises(KeyboardInterrupt):
        full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF)
    assert current_manifest(spark, target) is None
    begun = list_names(spark, f"{target}/_runs")
    built = []
    monkeypatch.setattr(refresh, "write_table", lambda df, table, path, **kw: (built.append(table.name), real(df, table, path, **kw))[1])
    if last == "fact_sales":
        monkeypatch.setattr(refresh, "customer_dimension", None)
        monkeypatch.setattr(refresh, "keyed_lines", None)
    full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF)
    assert built == list(LOAD_ORDER[LOAD_ORDER.index(last) + 1:])
    assert [current_manifest(spark, target).run_id] == begun
    assert _rows(read_star(spark, target)) == _rows(read_star(spark, whole))


def test_another_source_or_argument_is_another_run(spark, source, monkeypatch):
    target = staging_path(spark, "refresh-test")
    real = refresh.publish
    monkeypatch.setattr(refresh, "publish", lambda *a, **kw: 1 / 0)
    src = read_retail_source(spark, source)
    for kw in ({}, {"as_of": dt.date(2023, 1, 1)}, {"source_version": "v2"}, {"resume": False}):
        with pytest.raises(ZeroDivisionError):
            full_refresh(spark, src, target, **({"as_of": AS_OF} | kw))
    assert len(list_names(spark, f"{target}/_runs")) == 4
    src.product_category.withColumn("category_name", src.product_category.category_name).limit(1).write.mode("append").parquet(f"{source}/product_category")
    with pytest.raises(ZeroDivisionError):
        full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF)
    assert len(list_names(spark, f"{target}/_runs")) == 5
    monkeypatch.setattr(refresh, "publish", real)
    assert refresh.source_fingerprint(spark, retail_fixture(spark)) is None


def test_digests_of_written_tables(spark, source):
    target = staging_path(spark, "refresh-test")
    full_refresh(spark, read_retail_source(spark, source), target, as_of=AS_OF, fact_partition_by=("order_date_key",))
    manifest = current_manifest(spark, target)
    rows = run_digests(spark, target, manifest).collect()
    assert [r.table_name for r in rows] == list(LOAD_ORDER) and all(r.as_written for r in rows)
    # rows that were changed, dropped or doubled afterwards are noticed
    dim = read_run(spark, target, manifest)["dim_product"]
    dim.limit(1).write.mode("append").parquet(table_path(target, "dim_product", manifest.run_id))
    assert {r.table_name: r.as_written for r in run_digests(spark, target, manifest).collect()} == {
        n: n != "dim_product" for n in LOAD_ORDER}


def test_old_runs_expire(spark):
    target = staging_path(spark, "refresh-test")
    runs = []
    for _ in range(3):
        full_refresh(spark, retail_fixture(spark), target, as_of=AS_OF)
        runs.append(current_manifest(spark, target).run_id)
    assert expire_runs(spark, target, keep=2) == runs[:1]
    assert len(list_names(spark, f"{target}/dim_date")) == 2 and read_star(spark, target)["fact_sales"].count() == 5
    assert manifests.get_record(spark, record_path(target, runs[0], "published")) == {"version": 1}


def test_default_calendar_covers_whole_years(spark):
    src = retail_fixture(spark)
    target = staging_path(spark, "refresh-test")
    report = {r.table_name: r.rows_written for r in
              full_refresh(spark, src, target, as_of=dt.date(2024, 12, 31)).collect()}
    assert report["dim_date"] == 365 + 366          # 2023 and 2024


def test_star_views_answer_sql(spark):
    from starloom.plans.refresh import register_views
    from starloom.plans.report import sales_report

    src = retail_fixture(spark)
    target = staging_path(spark, "refresh-test")
    full_refresh(spark, src, target, as_of=dt.date(2024, 12, 31))
    star = read_star(spark, target)
    register_views(star, prefix="rpt_")
    sql = spark.sql("""
        SELECT f.sales_key, f.order_id, f.order_line_id, o.full_date AS order_date,
               s.full_date AS ship_date, c.full_name AS customer_name, st.order_status,
               f.net_sales_amount
        FROM rpt_fact_sales f
        JOIN rpt_dim_date o ON o.date_key = f.order_date_key
        LEFT JOIN rpt_dim_date s ON s.date_key = f.ship_date_key
        JOIN rpt_dim_customer c ON c.customer_key = f.customer_key
        JOIN rpt_dim_product p ON p.product_key = f.product_key
        JOIN rpt_dim_geography g ON g.geography_key = f.geography_key
        JOIN rpt_dim_order_status st ON st.order_status_key = f.order_status_key
        ORDER BY f.order_id, f.order_line_id LIMIT 100""").collect()
    api = sales_report(star["fact_sales"], star["dim_date"], star["dim_customer"],
                       star["dim_product"], star["dim_geography"], star["dim_order_status"])
    cols = ["sales_key", "order_id", "order_line_id", "order_date", "ship_date",
            "customer_name", "order_status", "net_sales_amount"]
    assert [tuple(r) for r in sql] == [tuple(r) for r in api.select(*cols).collect()]


def test_fact_partitioned_by_order_date(spark):
    src = retail_fixture(spark)
    target = staging_path(spark, "refresh-test")
    full_refresh(spark, src, target, as_of=dt.date(2024, 12, 31),
                 fact_partition_by=("order_date_key",))
    fact = read_star(spark, target)["fact_sales"]
    assert fact.columns == TARGET_TABLES["fact_sales"].columns
    assert fact.count() == 5
    assert sorted(r.order_date_key for r in fact.select("order_date_key").distinct().collect()) \
        == [20231231, 20240115, 20240120, 20240229]
    # a date filter prunes to one folder
    assert fact.where("order_date_key = 20240115").count() == 2


def test_drop_staging_removes_only_newer_folders(spark):
    import os

    from starloom.sinks.staging import drop_staging, stage, staging_mark

    keep = stage(spark.range(3), "keep")
    mark = staging_mark()
    gone = staging_path(spark, "gone")
    spark.range(2).write.parquet(gone)
    assert drop_staging(spark, mark) == 1
    local = gone.replace("file:", "")
    assert not os.path.exists(local)
    assert keep.count() == 3


def test_staging_of_two_threads_is_dropped_apart(spark):
    import threading

    from starloom.sinks.staging import drop_staging, stage, staging_mark

    kept = []

    def other():
        kept.append(stage(spark.range(3), "other"))

    mark = staging_mark()
    own = stage(spark.range(2), "own")
    t = threading.Thread(target=other)
    t.start()
    t.join()
    assert own.count() == 2 and drop_staging(spark, mark) == 1
    assert kept[0].count() == 3


def test_read_table_by_uri_of_a_plain_folder(spark, tmp_path):
    from starloom.sources.readers import read_table

    spark.range(4).write.parquet(str(tmp_path / "country"))
    assert read_table(spark, f"file://{tmp_path}", "country").count() == 4
    assert read_table(spark, str(tmp_path), "country").count() == 4


def test_checkpoint_folder_on_a_stock_session(tmp_path):
    """In a fresh process without defaults: made up only on a local master, and setCheckpointDir is followed."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from starloom.config import ensure_checkpoint_dir
from starloom.sinks.staging import stage
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
if sys.argv[1] == "given":
    spark.sparkContext.setCheckpointDir({str(tmp_path / "shared")!r})
    assert "shared" in ensure_checkpoint_dir(spark)
assert stage(spark.range(5), "x").count() == 5
if sys.argv[1] == "given":
    import pathlib
    assert list(pathlib.Path({str(tmp_path / "shared")!r}).rglob("starloom-staging/x-*/part-*.parquet"))
"""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    for kind in ("given", "none"):
        done = subprocess.run([sys.executable, "-c", code, kind], env=env, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr[-2000:]


def test_no_checkpoint_folder_on_a_cluster_is_an_error():
    import pytest

    from starloom.config import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)
