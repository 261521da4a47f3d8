"""Scalar column expressions used by the dimension and fact builders."""

from starloom.functions.dates import (
    calendar_year_boundaries,
    date_key,
    days_between,
    iso_day_of_week,
    monday_week_of_year,
    month_end,
    nullable_date_key,
)
from starloom.functions.money import discount_amount, gross_amount, round_money
from starloom.functions.text import char_length_over, join_names

__all__ = [
    "calendar_year_boundaries", "date_key", "days_between", "iso_day_of_week",
    "monday_week_of_year", "month_end", "nullable_date_key", "discount_amount",
    "gross_amount", "round_money", "char_length_over", "join_names",
]
