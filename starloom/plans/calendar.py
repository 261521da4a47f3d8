"""Calendar (date) dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, iso_day_of_week, monday_week_of_year
from starloom.bounds import mark_rows
from starloom.schemas import DIM_DATE, conform

def calendar_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, 18 columns.

    Days come from ``spark.range``, so rows are generated in parallel tasks;
    the driver only computes the day count.
    """
    if end < start:
        raise ValueError(f"calendar end {end} is before start {start}")
    n = (end - start).days + 1
    days = spark.range(n).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return mark_rows(calendar_columns(days), n)


def calendar_covering(*dates: Column, source: DataFrame) -> DataFrame:
    """Whole calendar years covering every non-NULL value of ``dates`` in ``source``.

    The span comes from one global min/max aggregate (partial aggregates per
    task, one row - two dates - to the driver); the days are then generated
    by ``calendar_dimension``, so the calendar's size is known exactly and
    depends on the years spanned, not on the number of source rows. An empty
    source gives an empty calendar.
    """
    lo = F.least(*[F.min(d) for d in dates]) if len(dates) > 1 else F.min(dates[0])
    hi = F.greatest(*[F.max(d) for d in dates]) if len(dates) > 1 else F.max(dates[0])
    row = source.agg(lo.alias("lo"), hi.alias("hi")).first()
    spark = source.sparkSession
    if row is None or row.lo is None:
        empty = spark.range(0).select(F.lit(None).cast("date").alias("full_date"))
        return mark_rows(calendar_columns(empty), 0)
    return calendar_dimension(spark, dt.date(row.lo.year, 1, 1), dt.date(row.hi.year, 12, 31))


def calendar_columns(days: DataFrame) -> DataFrame:
    """Derive the 18 calendar columns from a frame with a ``full_date`` column."""
    d = F.col("full_date")
    dow = iso_day_of_week(d)
    q = F.quarter(d)
    out = days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        monday_week_of_year(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        q.alias("quarter_number"),
        F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
        F.year(d).alias("year_number"),
        F.when(dow >= 6, 1).otherwise(0).alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        # The fiscal calendar equals the calendar year.
        F.year(d).alias("fiscal_year"),
        q.alias("fiscal_quarter"),
        F.month(d).alias("fiscal_month"),
    )
    return conform(out, DIM_DATE)
