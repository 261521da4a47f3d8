"""Star-join sales report.

The report joins ``fact_sales`` to the order-date calendar (inner), the
ship-date calendar (left outer: unshipped lines keep a NULL ship date), and
the customer, product, geography and order-status dimensions (inner), then
returns the first ``n`` lines by order and line id.

``topk_first`` (the default) is one plan at every size:

1. fact rows whose calendar, status and geography keys have a dimension row
   (semi-joins on narrow keys; these dimensions do not grow with the sales);
2. the first ``n`` of them in two steps: the first ``n`` of each of ``TOP_BUCKETS``
   hash buckets, cut to ``n`` a task before they are shuffled, then the first
   ``n`` of those ``n * TOP_BUCKETS`` rows, so no task merges rows of every task;
3. the attributes, joined to those ``n`` rows, which are the broadcast side
   (``n`` is the bound); each dimension is scanned, never shuffled.

A customer or product key without a dimension row would drop a line in step 3;
only then fewer than ``n`` lines are left and the ``join_first`` plan, the star
join of the whole fact followed by the same two steps, gives the answer.

With the ranges of the fact's files (``sinks.ranges``) steps 1 to 3 run over the first files by their
least order tuple: as many as hold ``n`` rows, then eight times as many, and so on, until ``n`` of
the rows below the next file's least tuple are in the report. Rows below it are complete, so the lines are the
same as those of the whole fact, which is read where ``MOST_FILES`` files were not enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.bounds import keep_rows
from starloom.operators.keys import small_lookup
from starloom.sinks.ranges import MOST_FILES, FileRanges
from starloom.sinks.staging import stage

REPORT_ORDER = ("order_id", "order_line_id")
TOP_BUCKETS = 64
#: Files are opened so many times as many in each round.
MORE_FILES = 8


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``: by bucket first, then among the buckets' first."""
    bucket = F.pmod(F.xxhash64(*order), F.lit(TOP_BUCKETS))
    within = Window.partitionBy("_bucket").orderBy(*order)
    return (df.withColumn("_bucket", bucket).withColumn("_rank", F.row_number().over(within))
            .where(F.col("_rank") <= n).drop("_bucket", "_rank").orderBy(*order).limit(n))


def _star(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
          dim_product: DataFrame, dim_geography: DataFrame, dim_order_status: DataFrame,
          *, small_fact: bool = False) -> DataFrame:
    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small_fact else df

    f = fact.select("sales_key", "order_id", "order_line_id", "order_date_key",
                    "ship_date_key", "days_to_ship", "customer_key", "product_key",
                    "geography_key", "order_status_key", "quantity", "unit_price",
                    "discount_pct", "discount_amount", "gross_sales_amount",
                    "net_sales_amount")
    ord_dates = keep_rows(dim_date, dim_date.select(F.col("date_key").alias("_od_key"),
                                                     F.col("full_date").alias("order_date")))
    shp_dates = keep_rows(dim_date, dim_date.select(F.col("date_key").alias("_sd_key"),
                                                     F.col("full_date").alias("ship_date")))
    cust = keep_rows(dim_customer, dim_customer.select(
        F.col("customer_key").alias("_c_key"), F.col("full_name").alias("customer_name"),
        F.col("city").alias("customer_city"), F.col("state").alias("customer_state"),
        F.col("country").alias("customer_country")))
    prod = keep_rows(dim_product, dim_product.select(
        F.col("product_key").alias("_p_key"), "product_name", "brand", "category"))
    geo = keep_rows(dim_geography, dim_geography.select(
        F.col("geography_key").alias("_g_key"), F.col("city").alias("ship_city"),
        F.col("state").alias("ship_state"), F.col("country").alias("ship_country")))
    status = keep_rows(dim_order_status, dim_order_status.select(
        F.col("order_status_key").alias("_s_key"), "order_status"))

    if not small_fact:
        # Broadcast after a size check: the fact is never shuffled onto a
        # handful of dates, cities or statuses, nor shuffled at all when the
        # customer or product dimension is a normal-sized catalogue.
        ord_dates, cust, prod, geo, status = (
            small_lookup(d) for d in (ord_dates, cust, prod, geo, status))
    j = side(f).join(ord_dates, F.col("order_date_key") == F.col("_od_key"), "inner")
    # Left outer join: only the calendar side can be the broadcast side.
    j = j.join(small_lookup(shp_dates), F.col("ship_date_key") == F.col("_sd_key"), "left")
    j = side(j).join(cust, F.col("customer_key") == F.col("_c_key"), "inner")
    j = side(j).join(prod, F.col("product_key") == F.col("_p_key"), "inner")
    j = side(j).join(geo, F.col("geography_key") == F.col("_g_key"), "inner")
    j = side(j).join(status, F.col("order_status_key") == F.col("_s_key"), "inner")
    return j.select(
        "sales_key", "order_id", "order_line_id", "order_date", "ship_date", "days_to_ship",
        "customer_name", "customer_city", "customer_state", "customer_country",
        "product_name", "brand", "category", "ship_city", "ship_state", "ship_country",
        "order_status", "quantity", "unit_price", "discount_pct", "discount_amount",
        "gross_sales_amount", "net_sales_amount")


def _in_report(fact: DataFrame, dims: Sequence[DataFrame]) -> DataFrame:
    """Fact rows whose calendar, geography and status keys have a dimension row."""
    dim_date, _, _, dim_geography, dim_order_status = dims
    for dim, key, own in ((dim_date, "date_key", "order_date_key"),
                          (dim_geography, "geography_key", "geography_key"),
                          (dim_order_status, "order_status_key", "order_status_key")):
        keys = keep_rows(dim, dim.select(F.col(key).alias("_key")))
        fact = fact.join(small_lookup(keys), F.col(own) == F.col("_key"), "left_semi")
    return fact


def _first_of_files(files: FileRanges, dims: Sequence[DataFrame], n: int) -> DataFrame | None:
    """The first ``n`` rows of the fact that can be in the report, staged; None if the listed files do not tell."""
    listed = files.first()
    opened, rows = 0, 0
    while opened < min(len(listed), MOST_FILES) and rows < n:
        rows += listed[opened]["file_rows"]
        opened += 1
    while opened:
        lines = files.read([f["file"] for f in listed[:opened]])
        if opened < len(listed):
            lines = lines.where(files.below(listed[opened]["least"]))
        top = stage(first_rows(_in_report(lines, dims), REPORT_ORDER, n), "report-top")
        if opened == len(listed) or top.count() == n:
            return top
        if opened == MOST_FILES:
            break
        opened = min(opened * MORE_FILES, len(listed), MOST_FILES)
    return None


def sales_report(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
                 dim_product: DataFrame, dim_geography: DataFrame,
                 dim_order_status: DataFrame, *, n: int | None = 100,
                 strategy: str = "topk_first", ordered: bool = True,
                 files: FileRanges | None = None) -> DataFrame:
    """The 23-column report, first ``n`` lines by (order_id, order_line_id).

    ``n=None`` returns every line, sorted if ``ordered``. ``strategy`` is
    ``topk_first`` or ``join_first`` (see the module docstring); both return
    the same rows. ``files``, the ranges of the fact's files by ``REPORT_ORDER``, lets
    ``topk_first`` open only the first of them.
    """
    dims = (dim_date, dim_customer, dim_product, dim_geography, dim_order_status)
    if n is None:
        lines = _star(fact, *dims)
        return lines.orderBy(*REPORT_ORDER) if ordered else lines
    if strategy == "join_first":
        return first_rows(_star(fact, *dims), REPORT_ORDER, n)
    if strategy != "topk_first":
        raise ValueError(f"unknown strategy {strategy!r}")

    top = _first_of_files(files, dims, n) if files is not None else None
    if top is None:
        top = stage(first_rows(_in_report(fact, dims), REPORT_ORDER, n), "report-top")
    joined = stage(_star(top, *dims, small_fact=True), "report-lines")
    if joined.count() < min(n, top.count()):
        return sales_report(fact, *dims, n=n, strategy="join_first")
    return joined.orderBy(*REPORT_ORDER).limit(n)
