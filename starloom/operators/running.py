"""Running (period-to-date) totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                   measures: Mapping[str, str | Column]) -> DataFrame:
    """Add ``name = sum(measure)`` from the partition start up to the current row.

    The frame is ``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW`` ordered by
    ``order_col``; a period with no row simply has no output row. All measures
    share one window specification, so Spark evaluates them in a single
    ``Window`` node. ``order_col`` must be unique inside a partition for the
    result to be deterministic.
    """
    w = (Window.partitionBy(*partition_cols).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df
    for name, measure in measures.items():
        m = F.col(measure) if isinstance(measure, str) else measure
        out = out.withColumn(name, F.sum(m).over(w))
    return out
