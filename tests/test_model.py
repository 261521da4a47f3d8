"""Dimensions, fact, snapshot and report on the hand-made fixture (edge rows per trap)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom.plans.calendar import calendar_dimension
from starloom.plans.dimensions import (
    customer_dimension,
    geography_dimension,
    order_status_dimension,
    product_dimension,
)
from starloom.plans.facts import keyed_lines, sales_fact
from starloom.plans.report import sales_report
from starloom.plans.snapshot import sales_monthly_snapshot
from starloom.schemas import DIM_CUSTOMER, FACT_SALES, FACT_SALES_MONTHLY_SNAPSHOT
from tests.fixtures import TS, retail_fixture

AS_OF = dt.date(2024, 12, 31)


def build(spark, src, status_dim=None):
    cust = customer_dimension(src, AS_OF)
    prod = product_dimension(src)
    geo = geography_dimension(src)
    status = status_dim if status_dim is not None else order_status_dimension(src)
    lines = keyed_lines(src, cust, prod, geo)
    return dict(cust=cust, prod=prod, geo=geo, status=status, lines=lines,
                fact=sales_fact(lines, status), snap=sales_monthly_snapshot(lines))


@pytest.fixture(scope="module")
def model(spark):
    return build(spark, retail_fixture(spark))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_customer_dimension(model):
    rows = by(model["cust"], "customer_id")
    assert model["cust"].columns == DIM_CUSTOMER.columns
    assert rows[1].customer_key == 1 and rows[3].customer_key == 3
    assert rows[1].full_name == "Ada Lane"
    assert rows[1].age_band == "25-34"      # 2024 - 1990 boundaries = 34
    assert rows[2].age_band == "55+"        # NULL birth date
    assert rows[3].age_band == "18-24"      # under 18
    assert (rows[2].city, rows[2].state_code, rows[2].country_code) == ("Springfield", "SO", "AR")
    assert (rows[1].effective_from, rows[1].effective_to, rows[1].is_current) == (
        dt.date(2022, 1, 1), None, 1)


def test_product_dimension(model):
    rows = by(model["prod"], "product_id")
    assert rows[50].brand == "Acme" and rows[50].brand_country == "Borduria"
    assert rows[51].category == "Toys" and rows[51].product_status == "Retired"
    assert rows[50].unit_of_measure == "EA" and rows[50].current_unit_price == D("0.35")
    assert sorted(r.product_key for r in rows.values()) == [1, 2]


def test_geography_equal_city_names(model):
    rows = [tuple(r) for r in model["geo"].orderBy("geography_key").collect()]
    assert rows == [(1, "Springfield", "North", "NO", "Arcadia", "AR"),
                    (2, "Springfield", "South", "SO", "Arcadia", "AR"),
                    (3, "Harbor", "Upland", "UP", "Borduria", "BO")]


def test_order_status_dimension(model):
    assert [tuple(r) for r in model["status"].orderBy("order_status_key").collect()] == [
        (1, "Completed"), (2, "Open")]


def test_fact_rows_and_measures(model):
    f = model["fact"]
    assert f.columns == FACT_SALES.columns
    rows = by(f, "order_line_id")
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert [rows[i].sales_key for i in range(1, 6)] == [1, 2, 3, 4, 5]
    r1 = rows[1]
    assert (r1.order_date_key, r1.ship_date_key, r1.days_to_ship) == (20240115, 20240118, 3)
    assert (r1.gross_sales_amount, r1.discount_amount, r1.net_sales_amount) == (
        D("0.35"), D("0.02"), D("0.33"))
    assert r1.cost_amount is None and r1.gross_margin_amount is None
    # unshipped line: no ship key, no days to ship
    assert rows[3].ship_date_key is None and rows[3].days_to_ship is None
    # geography by name + state code + country code: no fan-out on equal city names
    assert (rows[1].geography_key, rows[4].geography_key, rows[5].geography_key) == (1, 2, 3)
    assert rows[5].discount_amount == D("6.00")     # 5.997 rounds half up
    assert rows[5].days_to_ship == 2


def test_net_is_passed_through(spark):
    lines = [(1, 500, 50, 1, D("0.35"), D("5.00"), D("9.99"))]
    m = build(spark, retail_fixture(spark, lines=lines))
    assert m["fact"].collect()[0].net_sales_amount == D("9.99")


def test_snapshot_rounds_after_sum(model):
    s = model["snap"]
    assert s.columns == FACT_SALES_MONTHLY_SNAPSHOT.columns
    rows = {(r.customer_key, r.product_key, r.snapshot_date_key): r for r in s.collect()}
    jan = rows[(1, 1, 20240131)]
    assert (jan.order_count, jan.quantity_sold) == (3, 3)          # counts lines
    assert jan.gross_sales_amount == D("1.05")
    assert jan.discount_amount == D("0.05")                         # 0.0525, not 3 x 0.02
    assert jan.net_sales_amount == D("0.99")
    assert rows[(2, 2, 20240229)].quantity_sold == 2                # leap-year month end
    assert sorted(r.snapshot_key for r in rows.values()) == [1, 2, 3]


def test_snapshot_ytd_resets_each_year(spark):
    orders = [(600, 1, dt.date(2023, 11, 3), None, "Completed"),
              (601, 1, dt.date(2023, 12, 9), None, "Completed"),
              (602, 1, dt.date(2024, 1, 2), None, "Completed"),
              (603, 1, dt.date(2024, 3, 2), None, "Completed"),
              (604, 1, dt.date(2024, 3, 28), None, "Completed")]
    lines = [(i + 1, 600 + i, 50, i + 1, D("1.00"), D("0.00"), D(f"{i + 1}.00"))
             for i in range(5)]
    m = build(spark, retail_fixture(spark, lines=lines, orders=orders))
    got = [(r.snapshot_date_key, r.order_count, r.quantity_sold, r.ytd_order_count,
            r.ytd_quantity_sold, r.ytd_net_sales)
           for r in m["snap"].orderBy("snapshot_key").collect()]
    assert got == [(20231130, 1, 1, 1, 1, D("1.00")), (20231231, 1, 2, 2, 3, D("3.00")),
                   (20240131, 1, 3, 1, 3, D("3.00")), (20240331, 2, 9, 3, 12, D("12.00"))]


def test_fact_drops_unknown_status_snapshot_keeps_it(spark):
    src = retail_fixture(spark)
    status = spark.createDataFrame([(1, "Completed")],
                                   "order_status_key long, order_status string")
    m = build(spark, src, status_dim=status)
    assert sorted(r.order_line_id for r in m["fact"].collect()) == [1, 2, 4, 5]
    assert sum(r.order_count for r in m["snap"].collect()) == 5


def test_reconcile_fact_and_snapshot(model):
    f = (model["fact"].groupBy((F.col("order_date_key") / 100).cast("int").alias("ym"))
         .agg(F.sum("net_sales_amount").alias("n"), F.count(F.lit(1)).alias("c")))
    s = (model["snap"].groupBy((F.col("snapshot_date_key") / 100).cast("int").alias("ym"))
         .agg(F.sum("net_sales_amount").alias("n"), F.sum("order_count").alias("c")))
    assert sorted(map(tuple, f.collect())) == sorted(map(tuple, s.collect()))


def test_report_inner_order_date_left_ship_date(spark, model):
    cal = calendar_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 2, 29))
    args = (model["fact"], cal, model["cust"], model["prod"], model["geo"], model["status"])
    full = sales_report(*args, n=None).collect()
    # order 503 (2023-12-31) is outside the calendar: gone
    assert [r.order_line_id for r in full] == [1, 2, 3, 4]
    assert full[2].ship_date is None                       # unshipped
    assert full[3].ship_date is None                       # shipped 2024-03-02, outside
    assert full[3].ship_city == "Springfield" and full[3].ship_state == "South"
    assert len(full[0]) == 23
    top = sales_report(*args, n=3).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in full[:3]]


def test_report_topk_first_falls_back_exactly(spark, model):
    cal = calendar_dimension(spark, dt.date(2023, 1, 1), dt.date(2024, 12, 31))
    # the first two fact rows point at a customer that does not exist
    fact = model["fact"].withColumn(
        "customer_key", F.when(F.col("order_line_id") <= 2, F.lit(999)).otherwise(
            F.col("customer_key")))
    args = (fact, cal, model["cust"], model["prod"], model["geo"], model["status"])
    a = [tuple(r) for r in sales_report(*args, n=2, strategy="topk_first").collect()]
    b = [tuple(r) for r in sales_report(*args, n=2, strategy="join_first").collect()]
    assert a == b and [r[2] for r in a] == [3, 4]


def test_empty_source_gives_empty_tables(spark):
    m = build(spark, retail_fixture(spark, lines=[]))
    assert m["fact"].count() == 0 and m["snap"].count() == 0
    assert m["fact"].columns == FACT_SALES.columns


def test_orphan_customer_drops_lines(spark):
    customers = [(1, "Ada", "Lane", "ada@example.org", None, None, 1000, TS)]
    m = build(spark, retail_fixture(spark, customers=customers))
    assert sorted(r.order_line_id for r in m["fact"].collect()) == [1, 2, 3]
