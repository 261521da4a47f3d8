"""Plan builders: calendar, dimensions, fact, snapshot, report and full refresh."""

from starloom.plans.calendar import calendar_columns, calendar_covering, calendar_dimension
from starloom.plans.dimensions import (
    age_band,
    customer_dimension,
    geography_dimension,
    order_status_dimension,
    product_dimension,
)
from starloom.plans.facts import customer_bridge, keyed_lines, line_measures, sales_fact
from starloom.plans.refresh import (
    full_refresh,
    read_run,
    read_star,
    register_views,
    run_digests,
    run_report,
)
from starloom.plans.report import sales_report
from starloom.plans.snapshot import monthly_aggregate, monthly_snapshot, sales_monthly_snapshot

__all__ = [
    "calendar_columns", "calendar_covering", "calendar_dimension", "age_band",
    "customer_dimension", "geography_dimension", "order_status_dimension",
    "product_dimension", "customer_bridge", "keyed_lines", "line_measures", "sales_fact",
    "full_refresh", "read_run", "read_star", "register_views", "run_digests", "run_report", "sales_report", "monthly_aggregate", "monthly_snapshot", "sales_monthly_snapshot",
]
