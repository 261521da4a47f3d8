"""Order-line sales fact.

Plan shape (the expensive part is the order-line stream; every dimension
lookup is a join whose strategy the planner picks from sizes):

1. ``customer_bridge``: current customers -> (customer_key, geography_key).
   The geography lookup is by city name + state code + country code.
   Lookups are broadcast only after a size check (``small_lookup``); over
   the bound they are shuffle joins and AQE splits skewed keys.
2. orders join the bridge on ``customer_id``. This puts the customer lookup
   on the order table, which is several times smaller than the line table,
   instead of repeating it per line.
3. lines join keyed orders on ``order_id`` and current products on
   ``product_id`` (``keyed_lines``). Fact and snapshot share this frame.
4. the fact adds the order-status key and per-line measures, then numbers
   rows by ``order_line_id`` with the dense key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, days_between, nullable_date_key
from starloom.functions.money import discount_amount, gross_amount, round_money
from starloom.operators.keys import (
    current_rows,
    dense_key,
    resolve_key,
    small_lookup,
)
from starloom.schemas import FACT_SALES, MONEY, conform
from starloom.sources.retail import RetailSource

GEOGRAPHY_NATURAL_KEY = (("city", "city"), ("state_code", "state_code"),
                         ("country_code", "country_code"))


def customer_bridge(dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """``customer_id -> customer_key, geography_key`` for current customers."""
    cur = current_rows(dim_customer).select("customer_id", "customer_key", "city",
                                            "state_code", "country_code")
    # City, state and country are no declared key, so two equal cities give two
    # rows here; the customers' row bound does not carry over.
    return resolve_key(cur, dim_geography, GEOGRAPHY_NATURAL_KEY, "geography_key",
                       small=True).select("customer_id", "customer_key", "geography_key")


def keyed_lines(src: RetailSource, dim_customer: DataFrame, dim_product: DataFrame,
                dim_geography: DataFrame) -> DataFrame:
    """Order lines with order attributes and customer, geography and product keys.

    Lines whose order, customer (current version), geography or product
    (current version) is missing are dropped, as inner joins do.
    """
    order_cols = ["order_id", "customer_id", "order_date", "order_status"]
    line_cols = ["order_line_id", "order_id", "product_id", "quantity", "unit_price",
                 "discount_pct", "line_total"]
    if "ship_date" in src.sales_order_line.columns:
        line_cols.append("ship_date")
    else:
        order_cols.append("ship_date")
    # Customers and products are broadcast only when a size check proves them
    # small (a typical catalogue); at billions of rows they are shuffle joins.
    orders = src.sales_order.select(*order_cols).join(
        small_lookup(customer_bridge(dim_customer, dim_geography)), "customer_id", "inner")
    # Lines x orders is the large x large join of the model: declare it a
    # sort-merge join so a compressed-file size estimate never turns the line
    # table into a broadcast (AQE still splits skewed partitions).
    lines = (src.sales_order_line.select(*line_cols).hint("merge")
             .join(orders, "order_id", "inner"))
    return resolve_key(lines, dim_product, [("product_id", "product_id")], "product_key",
                       small=True)


def line_measures(df: DataFrame) -> DataFrame:
    """Date keys, gross / discount / net amounts and days to ship for each line.

    Gross and discount are rounded per line to the fact's ``decimal(10,2)``
    (a value that does not fit raises under ANSI mode); net is the source line
    total passed through, never recomputed from gross and discount.
    """
    shipped = F.col("ship_date").isNotNull()
    return df.select(
        "*",
        date_key("order_date").alias("order_date_key"),
        nullable_date_key("ship_date").alias("ship_date_key"),
        round_money(discount_amount("unit_price", "quantity", "discount_pct"))
        .cast(MONEY).alias("discount_amount"),
        round_money(gross_amount("unit_price", "quantity")).cast(MONEY)
        .alias("gross_sales_amount"),
        F.col("line_total").alias("net_sales_amount"),
        F.lit(None).cast("decimal(10,2)").alias("cost_amount"),
        F.lit(None).cast("decimal(10,2)").alias("gross_margin_amount"),
        F.when(shipped, days_between("order_date", "ship_date").cast("smallint"))
        .alias("days_to_ship"),
    )


def sales_fact(lines: DataFrame, dim_order_status: DataFrame) -> DataFrame:
    """``fact_sales`` from ``keyed_lines``: one row per order line, 18 columns.

    ``lines`` should be staged: the key reads it three times, twice with its key columns alone. The measures are
    derived from the numbered lines, so that they do not cross the key's shuffle.
    """
    with_status = resolve_key(lines, dim_order_status, [("order_status", "order_status")],
                              "order_status_key", small=True)
    # A line can occur twice (two geography rows of one name); the further keys
    # make the order total, so the numbering does not depend on the run.
    keyed = dense_key(with_status.drop("customer_id", "order_status"), ["order_line_id", "customer_key", "product_key",
                                 "geography_key", "order_status_key"], "sales_key", size_of=lines)
    return conform(line_measures(keyed), FACT_SALES)
