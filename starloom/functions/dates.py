"""Calendar expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d: Column | str) -> Column:
    """``yyyyMMdd`` as an integer; NULL stays NULL."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def nullable_date_key(d: Column | str) -> Column:
    """Date key only when the date is present (``CASE WHEN d IS NOT NULL``)."""
    d = _c(d)
    return F.when(d.isNotNull(), date_key(d))


def iso_day_of_week(d: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(d)) + 1


def monday_week_of_year(d: Column | str) -> Column:
    """Week number with weeks starting on Monday; days before the first Monday are week 0.

    This is the C ``%W`` convention, not ISO-8601 (``weekofyear``): 2022-01-01
    is week 0 here and ISO week 52.
    """
    d = _c(d)
    return F.floor((F.dayofyear(d) + 7 - iso_day_of_week(d)) / 7)


def calendar_year_boundaries(start: Column | str, end: Column | str) -> Column:
    """Number of calendar-year boundaries crossed from ``start`` to ``end``.

    Counts boundaries, not completed years: 1990-12-31 to 1991-01-01 is 1.
    """
    return F.year(_c(end)) - F.year(_c(start))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Days from ``start`` to ``end`` (negative when ``end`` is earlier)."""
    return F.datediff(_c(end), _c(start))


def month_end(year: Column | str, month: Column | str) -> Column:
    """Last day of the month ``year``-``month``."""
    return F.last_day(F.make_date(_c(year), _c(month), F.lit(1)))


def quarter_of(d: Column | str) -> Column:
    return F.quarter(_c(d))
