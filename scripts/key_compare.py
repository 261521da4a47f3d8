"""Time the plain single-partition window against the dense key on lineitem."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.config import local_session  # noqa: E402
from pyspark.sql import Window, functions as F  # noqa: E402
from starloom.operators.keys import dense_key  # noqa: E402
from starloom.sources.tpch import LINE_ORDER  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINE_ORDER)
    for label, fn in (("plain window", lambda: li.withColumn("k", F.row_number().over(Window.orderBy(*LINE_ORDER)))),
                      ("dense key", lambda: dense_key(li, list(LINE_ORDER), "k"))):
        times = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        print(f"{label}: runs {[round(t, 2) for t in times]}")


if __name__ == "__main__":
    main()
