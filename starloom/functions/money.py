"""Decimal money expressions.

Arithmetic stays in ``DecimalType``, or in whole hundredths where many lines are summed up; rounding is HALF_UP to two places and
happens exactly where the caller asks for it (per line, or after a sum).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gross_amount(unit_price: Column | str, quantity: Column | str) -> Column:
    """Unrounded ``unit_price * quantity``."""
    return _c(unit_price) * _c(quantity)


def discount_amount(unit_price: Column | str, quantity: Column | str,
                    discount_pct: Column | str) -> Column:
    """Unrounded ``unit_price * quantity * discount_pct / 100`` (pct is in percent)."""
    return _c(unit_price) * _c(quantity) * _c(discount_pct) / 100


def _hundredths(x: Column | str) -> Column:
    """An amount of two decimal places as a whole number."""
    return (_c(x) * 100).cast("long")


def _amount(n: Column, unit: str, kind: str) -> Column:
    """``n`` units as the type that a sum of decimals has."""
    return (n.cast("decimal(28,0)") * F.lit(Decimal(unit))).cast(kind)


def sum_of_amounts(x: Column | str) -> Column:
    """The exact sum of a ``decimal(10,2)``: a sum of longs, which costs a fraction of one of wide decimals."""
    return _amount(F.sum(_hundredths(x)), "0.01", "decimal(20,2)")


def sum_of_gross(unit_price: Column | str, quantity: Column | str) -> Column:
    """The exact sum of ``gross_amount`` of a ``decimal(10,2)`` and a ``smallint``."""
    return _amount(F.sum(_hundredths(unit_price) * _c(quantity).cast("long")), "0.01", "decimal(26,2)")


def sum_of_discounts(unit_price: Column | str, quantity: Column | str, discount_pct: Column | str) -> Column:
    """The exact sum of ``discount_amount`` of a ``decimal(10,2)``, a ``smallint`` and a ``decimal(5,2)``.

    A line's discount in millionths can pass a long, so the high and the low bits of its gross hundredths are
    multiplied by the percentage and summed up apart.
    """
    gross, pct = _hundredths(unit_price) * _c(quantity).cast("long"), _hundredths(discount_pct)
    high, low = F.sum(F.shiftright(gross, 20) * pct), F.sum(gross.bitwiseAND(F.lit((1 << 20) - 1)) * pct)
    return _amount(high.cast("decimal(19,0)") * F.lit(Decimal(1 << 20)) + low.cast("decimal(19,0)"), "0.000001", "decimal(36,8)")


def round_money(x: Column) -> Column:
    return F.round(x, 2)
