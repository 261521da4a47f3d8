"""Monthly periodic snapshot with year-to-date running totals.

Plan: partial aggregate per task -> hash exchange on the group keys -> final
aggregate, staged -> exchange on the key's bucket of (dimension keys, year) -> sort by (bucket, dimension
keys, year, month) -> year-to-date window -> row numbering. Rows of one dimension
tuple and year share a bucket, so the windows of the running totals and of the
snapshot key are both clustered by it and share one exchange and one sort. Each
running total holds at most twelve rows, so a hot customer cannot make one group large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_key, month_end
from starloom.functions.money import (
    discount_amount,
    gross_amount,
    round_money,
    sum_of_amounts,
    sum_of_discounts,
    sum_of_gross,
)
from starloom.operators.keys import dense_key
from starloom.operators.running import running_totals
from starloom.schemas import FACT_SALES, FACT_SALES_MONTHLY_SNAPSHOT, conform
from starloom.sinks.staging import stage

REFERENCE_GRAIN = ("customer_key", "product_key", "geography_key")


#: Declared types of the summed columns.
SUMMED = {c: FACT_SALES.schema[c].dataType for c in ("unit_price", "quantity", "discount_pct")} | {
    "line_total": FACT_SALES.schema["net_sales_amount"].dataType}


def _fits(kind: T.DataType, declared: T.DataType) -> bool:
    """Whether values of a type are among those of the declared one."""
    if isinstance(declared, T.DecimalType) and isinstance(kind, T.DecimalType):
        return kind.scale <= declared.scale and kind.precision - kind.scale <= declared.precision - declared.scale
    return kind == declared


def monthly_aggregate(lines: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per ``dims`` x year x month: line count, quantity and rounded money sums.

    Money is summed unrounded and rounded once per group (a per-line rounded
    sum can differ by cents). ``order_count`` counts lines, not orders. Sums of the declared types are
    taken over whole hundredths; other types are summed as they are.
    """
    if all(_fits(lines.schema[c].dataType, t) for c, t in SUMMED.items()):
        gross, net = sum_of_gross("unit_price", "quantity"), sum_of_amounts("line_total")
        discount = sum_of_discounts("unit_price", "quantity", "discount_pct")
    else:
        gross, net = F.sum(gross_amount("unit_price", "quantity")), F.sum("line_total")
        discount = F.sum(discount_amount("unit_price", "quantity", "discount_pct"))
    return (lines.groupBy(*dims, F.year("order_date").alias("year_number"),
                          F.month("order_date").alias("month_number"))
            .agg(F.count("order_line_id").alias("order_count"),
                 F.sum("quantity").alias("quantity_sold"),
                 round_money(gross).alias("gross_sales_amount"),
                 round_money(discount).alias("discount_amount"),
                 round_money(net).alias("net_sales_amount")))


def monthly_snapshot(lines: DataFrame, dims: Sequence[str] = REFERENCE_GRAIN, *,
                     key_name: str = "snapshot_key", count_type: T.DataType = T.IntegerType(),
                     money_type: T.DataType = T.DecimalType(12, 2)) -> DataFrame:
    """Monthly snapshot at grain ``dims`` x month with year-to-date totals.

    The year-to-date totals restart every ``year_number`` and include the
    current month; months without sales have no row. The key numbers rows
    1..N in (dims, year, month) order. Output columns: key, snapshot_date_key
    (last day of the month), dims, period measures, gross_margin_amount
    (NULL), ytd_order_count, ytd_quantity_sold, ytd_net_sales.
    """
    dims = list(dims)
    # Staged: the key reads it three times, and the lines are aggregated once. The measures have the types
    # of the snapshot before that, as the sums' own take three times the room on disk and in the shuffle.
    kinds = {"order_count": count_type, "quantity_sold": count_type, "gross_sales_amount": money_type,
             "discount_amount": money_type, "net_sales_amount": money_type}
    agg = stage(monthly_aggregate(lines, dims).withColumns({c: F.col(c).cast(t) for c, t in kinds.items()}), "monthly")

    def year_to_date(rows: DataFrame, bucket: str) -> DataFrame:
        return running_totals(rows, [bucket, *dims, "year_number"], "month_number", {
            "ytd_order_count": "order_count",
            "ytd_quantity_sold": "quantity_sold",
            "ytd_net_sales": "net_sales_amount",
        })

    ytd = dense_key(agg, [*dims, "year_number", "month_number"], key_name,
                    range_cols=[*dims, "year_number"], within=year_to_date)
    return ytd.select(
        F.col(key_name),
        date_key(month_end("year_number", "month_number")).alias("snapshot_date_key"),
        *dims,
        *kinds,
        F.lit(None).cast(money_type).alias("gross_margin_amount"),
        F.col("ytd_order_count").cast(count_type).alias("ytd_order_count"),
        F.col("ytd_quantity_sold").cast(count_type).alias("ytd_quantity_sold"),
        F.col("ytd_net_sales").cast(money_type).alias("ytd_net_sales"),
    )


def sales_monthly_snapshot(lines: DataFrame) -> DataFrame:
    """``fact_sales_monthly_snapshot`` at customer x product x geography x month."""
    return conform(monthly_snapshot(lines), FACT_SALES_MONTHLY_SNAPSHOT)
