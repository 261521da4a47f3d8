"""The report over the first files of the fact."""

import datetime as dt

import pytest

from starloom.operators import keys
from starloom.plans import report
from starloom.plans.refresh import current_manifest, fact_ranges, full_refresh, read_star, run_report
from starloom.plans.report import REPORT_ORDER, sales_report
from starloom.schemas import TARGET_TABLES
from starloom.sinks.manifest import delete_folder, expire_runs, list_names, ranges_path
from starloom.sinks.ranges import FileRanges, file_ranges
from starloom.sinks.staging import staging_path
from tests.fixtures import D, retail_fixture

AS_OF = dt.date(2024, 12, 31)
LINES = 400


def _source(spark):
    """Two lines an order; every fourth order lies outside a calendar that starts in 2024."""
    day = lambda i: dt.date(2023, 5, 1) if i % 4 == 3 else dt.date(2024, 3, 1) + dt.timedelta(days=i % 30)
    orders = [(1000 + i, 1 + i % 3, day(i), None, "Open" if i % 2 else "Completed") for i in range(LINES // 2)]
    lines = [(i + 1, 1000 + i // 2, 50 + i % 2, 1, D("0.35"), D("5.00"), D("0.33")) for i in range(LINES)]
    return retail_fixture(spark, orders=orders, lines=lines)


@pytest.fixture(scope="module")
def target(spark):
    """A published run whose fact lies in eight files."""
    with pytest.MonkeyPatch.context() as m:
        m.setattr(keys, "ROWS_PER_BUCKET", LINES // 20)
        place = staging_path(spark, "ranges-test")
        full_refresh(spark, _source(spark), place, as_of=AS_OF, calendar=(dt.date(2024, 1, 1), dt.date(2024, 12, 31)))
    return place


def _parts(spark, target):
    star = read_star(spark, target)
    return star["fact_sales"], [star[n] for n in ("dim_date", "dim_customer", "dim_product", "dim_geography", "dim_order_status")]


def _noting(files):
    opened = []

    def read(names):
        opened.append(len(names))
        return files.read(names)

    return FileRanges(files.files, files.order, read), opened


def test_files_of_the_fact_follow_each_other(spark, target):
    found = fact_ranges(spark, target, current_manifest(spark, target)).files.orderBy("least").collect()
    assert len(found) > 5 and sum(f["file_rows"] for f in found) == LINES
    fact, _ = _parts(spark, target)
    assert all("/" not in f["file"] for f in found)
    ends = sorted((r[0], r[1]) for r in fact.selectExpr("_metadata.file_path AS p", "order_line_id AS k").groupBy("p")
                  .agg({"k": "min"}).join(fact.selectExpr("_metadata.file_path AS p", "order_line_id AS k").groupBy("p").agg({"k": "max"}), "p")
                  .drop("p").collect())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("n", [5, 40, 350])
def test_same_lines_and_few_files(spark, target, n):
    fact, dims = _parts(spark, target)
    files, opened = _noting(fact_ranges(spark, target, current_manifest(spark, target)))
    want = sales_report(fact, *dims, n=n, strategy="join_first").collect()
    assert sales_report(fact, *dims, n=n, files=files).collect() == want
    if n == 5:  # a file holds about 50 rows
        assert max(opened) <= 2
        assert run_report(spark, target, n=n).collect() == want
    if n == 40:
        assert max(opened) < len(files.files.collect())


def test_files_that_overlap_and_files_that_are_not_listed(spark, target, tmp_path, monkeypatch):
    fact, dims = _parts(spark, target)
    want = sales_report(fact, *dims, n=30, strategy="join_first").collect()
    place = str(tmp_path / "mixed")
    fact.repartition(16, "sales_key").write.parquet(place)
    mixed = spark.read.parquet(place)
    files, opened = _noting(FileRanges(file_ranges(mixed, REPORT_ORDER, "mixed"), REPORT_ORDER,
                                       lambda names: spark.read.parquet(*[f"{place}/{n}" for n in names])))
    assert sales_report(mixed, *dims, n=30, files=files).collect() == want
    assert opened == sorted(opened) and len(opened) > 1
    files, opened = _noting(files)
    monkeypatch.setattr(report, "MOST_FILES", 3)
    assert sales_report(mixed, *dims, n=30, files=files).collect() == want  # three files do not tell: the whole fact
    assert max(opened) <= 3


def test_lines_without_a_product_and_runs_without_ranges(spark, target):
    fact, dims = _parts(spark, target)
    dims[2] = dims[2].where("product_id <> 50")
    files = fact_ranges(spark, target, current_manifest(spark, target))
    want = sales_report(fact, *dims, n=20, strategy="join_first").collect()
    assert sales_report(fact, *dims, n=20, files=files).collect() == want and len(want) == 20
    other = staging_path(spark, "ranges-test")
    full_refresh(spark, retail_fixture(spark), other, as_of=AS_OF, fact_partition_by=("order_date_key",))
    first = current_manifest(spark, other)
    listed = fact_ranges(spark, other, first)
    assert all(f["file"].startswith("order_date_key=") for f in listed.files.collect())
    with_ranges = run_report(spark, other, n=3).collect()
    delete_folder(spark, ranges_path(other, "fact_sales", first.run_id))
    assert fact_ranges(spark, other, first) is None
    assert run_report(spark, other, n=3).collect() == with_ranges and len(with_ranges) == 3
    full_refresh(spark, retail_fixture(spark, lines=[]), other, as_of=AS_OF)
    assert run_report(spark, other, n=3).collect() == []
    expire_runs(spark, other, keep=1)
    assert len(list_names(spark, f"{other}/_ranges")) <= 1
    assert TARGET_TABLES["fact_sales"].columns == read_star(spark, other)["fact_sales"].columns
