"""Print the physical plans of the main stages (operator tree only).

Usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.txt
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from starloom.config import local_session  # noqa: E402
from starloom.operators.keys import resolve_key  # noqa: E402
from starloom.operators.running import running_totals  # noqa: E402
from starloom.plans.facts import keyed_lines, line_measures  # noqa: E402
from starloom.plans.report import REPORT_ORDER, _star  # noqa: E402
from starloom.plans.snapshot import monthly_aggregate  # noqa: E402
from starloom.queries import Model  # noqa: E402


def tree(df, width: int = 150) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    out = []
    for ln in buf.getvalue().splitlines():
        if not ln.strip() or ln.startswith("=="):
            continue
        ln = re.sub(r"#\d+L?", "", ln)
        out.append(ln[:width])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    m = Model(spark, sf_dir)
    lines = keyed_lines(m.src, m.dim_customer, m.dim_product, m.dim_geography)
    dims = ["customer_key", "product_key", "geography_key"]
    agg = monthly_aggregate(m.lines, dims)
    ranged = agg.repartitionByRange(*dims, "year_number").sortWithinPartitions(
        *dims, "year_number", "month_number")
    snapshot_stage = running_totals(ranged, [*dims, "year_number"], "month_number",
                                    {"ytd_order_count": "order_count"}).withColumn(
        "_sk_rid", F.monotonically_increasing_id())
    measured = line_measures(resolve_key(m.lines, m.dim_order_status,
                                         [("order_status", "order_status")],
                                         "order_status_key"))
    fact_stage = (measured.repartitionByRange("order_line_id")
                  .sortWithinPartitions("order_line_id")
                  .withColumn("_sk_rid", F.monotonically_increasing_id()))
    cand = m.fact.orderBy(*REPORT_ORDER).limit(100)
    report = _star(cand, m.dim_date, m.dim_customer, m.dim_product, m.dim_geography,
                   m.dim_order_status, small_fact=True)
    for title, df in (("keyed lines (orders x customer bridge, lines x orders, product key)",
                       lines),
                      ("fact key stage (status lookup, measures, range exchange, numbering)",
                       fact_stage),
                      ("snapshot stage (partial/final aggregate, one range exchange, "
                       "year-to-date window, numbering)", snapshot_stage),
                      ("report: top-100 candidates joined to the dimensions", report)):
        print(f"### {title}\n")
        print(tree(df))
        print()


if __name__ == "__main__":
    main()
