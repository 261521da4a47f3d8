"""Small hand-made source tables with the edge rows the tests need.

Rows are our own; they follow the source model's schemas exactly.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import SparkSession

from starloom.schemas import SOURCE_TABLES
from starloom.sources.retail import RetailSource

TS = dt.datetime(2021, 6, 1, 9, 0, 0)


def frame(spark: SparkSession, name: str, rows: list[tuple]):
    return spark.createDataFrame(rows, SOURCE_TABLES[name].schema)


def retail_fixture(spark: SparkSession, *, lines: list[tuple] | None = None,
                   orders: list[tuple] | None = None,
                   customers: list[tuple] | None = None) -> RetailSource:
    country = [(1, "Arcadia", "AR"), (2, "Borduria", "BO")]
    state = [(10, "North", "NO", 1), (11, "South", "SO", 1), (20, "Upland", "UP", 2)]
    # Two cities named "Springfield" in different states of one country.
    city = [(100, "Springfield", 10), (101, "Springfield", 11), (102, "Harbor", 20)]
    address = [(1000, "1 Main St", None, "11111", 100), (1001, "2 Main St", "Apt 3", "22222", 101),
               (1002, "3 Quay", None, "33333", 102)]
    customer = customers if customers is not None else [
        (1, "Ada", "Lane", "ada@example.org", None, dt.date(1990, 12, 31), 1000, TS),
        (2, "Bo", "Ng", "bo@example.org", "555", None, 1001, TS),
        (3, "Cy", "Oz", "cy@example.org", None, dt.date(2010, 1, 1), 1002, TS),
    ]
    category = [(1, "Tools"), (2, "Toys")]
    brand = [(1, "Acme", 2), (2, "Bolt", 1)]
    uom = [(1, "EA", "Each")]
    pstatus = [(1, "Active"), (2, "Retired")]
    product = [
        (50, "SKU-50", "Hammer", 1, 1, 1, D("0.35"), 1, D("1.250"), 12, dt.date(2021, 1, 1)),
        (51, "SKU-51", "Kite", 2, 2, 2, D("19.99"), 1, None, None, None),
    ]
    so = orders if orders is not None else [
        (500, 1, dt.date(2024, 1, 15), dt.date(2024, 1, 18), "Completed"),
        (501, 1, dt.date(2024, 1, 20), None, "Open"),
        (502, 2, dt.date(2024, 2, 29), dt.date(2024, 3, 2), "Completed"),
        (503, 3, dt.date(2023, 12, 31), dt.date(2024, 1, 2), "Completed"),
    ]
    sol = lines if lines is not None else [
        # three 5 % lines of 0.35 in one customer x product x month: per-line
        # discount rounds to 0.02 each (0.06 summed), the month sum is 0.0525 -> 0.05
        (1, 500, 50, 1, D("0.35"), D("5.00"), D("0.33")),
        (2, 500, 50, 1, D("0.35"), D("5.00"), D("0.33")),
        (3, 501, 50, 1, D("0.35"), D("5.00"), D("0.33")),
        (4, 502, 51, 2, D("19.99"), D("0.00"), D("39.98")),
        (5, 503, 51, 3, D("19.99"), D("10.00"), D("53.97")),
    ]
    data = {
        "country": country, "state": state, "city": city, "address": address,
        "customer": customer, "product_category": category, "brand": brand,
        "unit_of_measure": uom, "product_status": pstatus, "product": product,
        "sales_order": so, "sales_order_line": sol,
    }
    return RetailSource({n: frame(spark, n, rows) for n, rows in data.items()})
