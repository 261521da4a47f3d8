"""Plan-shape checks: the properties the design relies on at scale."""

import datetime as dt
import io
import re
from contextlib import redirect_stdout

from starloom.operators import keys
from starloom.operators.keys import dense_key
from starloom.plans.dimensions import (
    customer_dimension,
    geography_dimension,
    product_dimension,
)
from starloom.plans.facts import keyed_lines
from starloom.plans.snapshot import monthly_aggregate, monthly_snapshot
from starloom.queries import Model
from tests.fixtures import retail_fixture

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_lines_join_orders_is_sort_merge_and_scans_are_pruned(spark):
    m = Model(spark, SF)
    text = plan(keyed_lines(m.src, m.dim_customer, m.dim_product, m.dim_geography))
    assert "SortMergeJoin [order_id" in text
    orders_scan = [ln for ln in text.splitlines() if "o_orderkey" in ln and "FileScan" in ln]
    assert orders_scan and all("o_totalprice" not in ln and "o_orderpriority" not in ln
                               for ln in orders_scan)


def test_snapshot_windows_share_one_exchange_and_sort(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_BUCKET", 1)
    monkeypatch.setattr(keys, "TUPLES_PER_BUCKET", 1)
    src = retail_fixture(spark)
    cust = customer_dimension(src, dt.date(2024, 12, 31))
    lines = keyed_lines(src, cust, product_dimension(src), geography_dimension(src))
    dims = ["customer_key", "product_key", "geography_key"]
    # partial aggregate before the hash exchange: hot groups shrink before shuffling
    assert re.search(r"HashAggregate\(keys=.*partial_count", plan(monthly_aggregate(lines, dims)))
    # both windows, of the running totals and of the key, over one exchange and one sort
    above = plan(monthly_snapshot(lines, dims)).split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert above.count("Window [") == 2 and above.count("Exchange hashpartitioning") == 1 and above.count("Sort [") == 1


def test_only_bucket_counts_meet_in_one_partition(spark):
    df = spark.range(1000).selectExpr("id % 7 AS a", "id AS b")
    single = [ln for ln in plan(dense_key(df, ["a", "b"], "k", rows_per_bucket=100)).split("\n") if "SinglePartition" in ln]
    assert len(single) == 1  # the running sum over the buckets


def test_all_foreign_keys_of_a_child_in_one_scan(spark, tmp_path):
    from starloom.operators.checks import orphan_counts

    spark.range(50).selectExpr("id", "id % 5 AS a", "id % 7 AS b", "id % 9 AS c").write.parquet(str(tmp_path / "child"))
    child = spark.read.parquet(str(tmp_path / "child"))
    parents = [spark.range(n).toDF("pk") for n in (5, 6, 9)]
    text = plan(orphan_counts(child, [(c, p, "pk") for c, p in zip("abc", parents)]))
    assert len([ln for ln in text.split("\n") if "FileScan" in ln]) == 1


def test_few_key_lookups_are_broadcast(spark):
    m = Model(spark, SF)
    text = plan(keyed_lines(m.src, m.dim_customer, m.dim_product, m.dim_geography))
    assert re.search(r"BroadcastHashJoin \[city#\d+, state_code#\d+, country_code#\d+\]", text)
    assert "NestedLoop" not in text and "Cartesian" not in text
