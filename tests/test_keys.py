import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import keys
from starloom.operators.keys import bucket_bounds, dense_key, resolve_key, small_lookup


def _numbered(df, order):
    """Rows and the key that an un-partitioned window gives them."""
    return sorted(map(tuple, df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("long")).collect()), key=lambda r: r[-1])


def _keyed(df, order, **kw):
    return sorted(map(tuple, dense_key(df, order, "k", **kw).select(*df.columns, "k").collect()), key=lambda r: r[-1])


def test_dense_key_splits_a_hot_leading_value(spark):
    rnd = random.Random(7)
    # nine rows of ten share one leading value
    rows = [(0 if i % 10 else rnd.randint(1, 500), rnd.randint(0, 10**6), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    order = ["a", "b", "c"]
    assert _keyed(df, order, rows_per_bucket=100) == _numbered(df, order)
    bounds = bucket_bounds(df, order, rows_per_bucket=100)
    sizes = [r["count"] for r in bounds.bucket(df, order, "bucket").groupBy("bucket").count().collect()]
    assert len(sizes) == bounds.buckets and 25 <= bounds.buckets <= 60
    hot = bounds.bucket(df.where("a = 0"), order, "bucket").select("bucket").distinct().count()
    assert hot > 20 and max(sizes) < 400


@pytest.mark.parametrize("rows_per_bucket", [3, 40, 1000])
def test_dense_key_over_every_type_with_nulls(spark, rows_per_bucket):
    rnd = random.Random(rows_per_bucket)
    maybe = lambda v: None if rnd.random() < 0.2 else v
    rows = [(maybe(rnd.choice(["a", "a\u00e9", 'q"\\', "\n", ""])), maybe(rnd.choice([0.1, -2.5, float("inf"), float("-inf"), float("nan")])),
             maybe(Decimal(rnd.randrange(-500, 500)).scaleb(-2)), maybe(dt.date(2020, 1, rnd.randrange(1, 28))),
             maybe(dt.datetime(2020, 1, 1, 1, 2, 3, rnd.randrange(10**6))), maybe(rnd.random() < 0.5), i) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, x double, m decimal(10,2), d date, t timestamp_ntz, b boolean, i long")
    got, want = (sorted((r[-1], r[-2]) for r in f(df, df.columns)) for f in
                 (lambda *a: _keyed(*a, rows_per_bucket=rows_per_bucket), _numbered))
    assert got == want


def test_dense_key_prefix_range_and_within(spark):
    rows = [(g, m, g * 100 + m) for g in range(40) for m in range(1, 13) if (g + m) % 3]
    df = spark.createDataFrame(rows, "g long, m long, v long")

    def running(ranged, bucket):
        w = Window.partitionBy(bucket, "g").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
        return ranged.withColumn("run", F.sum("v").over(w))

    out = dense_key(df, ["g", "m"], "k", range_cols=["g"], rows_per_bucket=20, within=running).orderBy("k").collect()
    assert [(r.g, r.m) for r in out] == sorted((g, m) for g, m, _ in rows)
    assert [r.k for r in out] == list(range(1, len(rows) + 1))
    for r in out:
        assert r.run == sum(v for g, m, v in rows if g == r.g and m <= r.m)


def test_dense_key_of_no_rows_and_one_bucket(spark):
    assert dense_key(spark.createDataFrame([], "a long"), ["a"], "k").count() == 0
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert _keyed(df, ["s"]) == [(None, 1), ("a", 2), ("b", 3)]


def test_a_wrong_size_only_changes_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(keys, "TUPLES_PER_BUCKET", 4)
    df = spark.range(3000).selectExpr("pmod(xxhash64(id), 100000) AS a", "id AS b")
    for size_of in (spark.range(1), spark.range(200), spark.range(10**6)):
        assert _keyed(df, ["a", "b"], size_of=size_of, rows_per_bucket=100) == _numbered(df, ["a", "b"])
    # the sketch is held to its bound even where far fewer rows were counted
    assert bucket_bounds(df, ["a", "b"], size_of=spark.range(101), rows_per_bucket=100, max_buckets=7).buckets <= 7


def test_dense_key_is_lazy_and_shuffles_rows_once(spark, tmp_path):
    import io
    import re
    from contextlib import redirect_stdout

    spark.range(5000).selectExpr("id % 7 AS a", "id AS b", "uuid() AS wide").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    out = io.StringIO()
    with redirect_stdout(out):
        dense_key(df, ["a", "b"], "k", rows_per_bucket=500).explain("formatted")
    plan = out.getvalue()
    wide = [m for m in re.findall(r"Exchange\nInput \[\d+\]: (.*)", plan) if "wide" in m]
    assert len(wide) == 1 and "SinglePartition" not in "".join(wide)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_resolve_key_uses_current_rows_only(spark):
    dim = spark.createDataFrame([(1, 10, 1), (2, 10, 0), (3, 11, 1)],
                                "k long, nat long, is_current smallint")
    facts = spark.createDataFrame([(10,), (11,), (12,)], "nat long")
    got = sorted(tuple(r) for r in resolve_key(facts, dim, [("nat", "nat")], "k").collect())
    assert got == [(10, 1), (11, 3)]


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1,
                     max_size=200, unique=True),
       size=st.integers(1, 40))
def test_dense_key_property(spark, rows, size):
    df = spark.createDataFrame(rows, "a long, b long")
    assert _keyed(df, ["a", "b"], rows_per_bucket=size) == [(*r, i + 1) for i, r in enumerate(sorted(rows))]


def test_small_lookup_broadcasts_only_under_the_bound(spark):
    import io
    from contextlib import redirect_stdout

    def join_plan(lookup):
        buf = io.StringIO()
        with redirect_stdout(buf):
            spark.range(1000).join(lookup, "id").explain()
        return buf.getvalue()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in join_plan(small_lookup(spark.range(10), max_rows=10))
        assert "BroadcastHashJoin" not in join_plan(small_lookup(spark.range(50), max_rows=10))
        # few rows, but wide ones
        wide = spark.range(90).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
        assert "BroadcastHashJoin" not in join_plan(small_lookup(wide, max_bytes=90_000))
        assert "BroadcastHashJoin" in join_plan(small_lookup(wide.select("id"), max_bytes=90_000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dimensions_are_the_same_with_any_number_of_buckets(spark, monkeypatch):
    from starloom.plans.dimensions import (
        customer_dimension,
        geography_dimension,
        order_status_dimension,
        product_dimension,
    )
    from starloom.sources.tpch import retail_from_tpch

    def build():
        src = retail_from_tpch(spark, "/root/testdata/sf0.001")
        return [sorted(map(tuple, d.collect())) for d in (
            customer_dimension(src, dt.date(2024, 12, 31)), product_dimension(src),
            geography_dimension(src), order_status_dimension(src))]

    single = build()
    monkeypatch.setattr(keys, "ROWS_PER_BUCKET", 11)
    assert build() == single


def test_partitions_follow_each_other_after_one_shuffle(spark):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS a", "id AS b")
    keyed = dense_key(df, ["a"], "k", rows_per_bucket=50)
    text = keyed._jdf.queryExecution().executedPlan().toString()
    window = text.split("Window [", 1)[1]
    assert window.split("BroadcastExchange", 1)[0].count("Exchange") == 1
    ends = sorted((r[1], r[2], r[0]) for r in keyed.selectExpr("spark_partition_id() AS p", "k").groupBy("p")
                  .agg({"k": "min", "p": "count"}).join(keyed.selectExpr("spark_partition_id() AS p", "k").groupBy("p").agg({"k": "max"}), "p")
                  .selectExpr("p", "`min(k)`", "`max(k)`").collect())
    assert len(ends) == 8 and [e[2] for e in ends] == sorted(e[2] for e in ends)
    assert all(a[1] + 1 == b[0] for a, b in zip(ends, ends[1:]))
