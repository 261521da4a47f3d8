"""Steps whose cost a task or a row must not grow with the tables."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import keys
from starloom.operators.keys import bucket_bounds, dense_key
from starloom.sinks.digest import hash_sum


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_take_the_leading_column_where_it_has_no_hot_value(spark):
    df = spark.range(2000).selectExpr("id DIV 4 AS a", "id % 4 AS b", "CAST(id AS string) AS c")
    bounds = bucket_bounds(df, ["a", "b", "c"], rows_per_bucket=100)
    assert bounds.width == 1 and bounds.buckets > 10
    sizes = [r["count"] for r in bounds.bucket(df, ["a", "b", "c"], "bucket").groupBy("bucket").count().collect()]
    assert len(sizes) == bounds.buckets and max(sizes) < 300
    got = sorted((r.k, r.a, r.b) for r in dense_key(df, ["a", "b", "c"], "k", rows_per_bucket=100).collect())
    assert got == [(i + 1, i // 4, i % 4) for i in range(2000)]


def test_bounds_take_more_columns_where_the_leading_one_is_null_or_hot(spark):
    df = spark.range(2000).selectExpr("IF(id % 2 = 0, NULL, 7) AS a", "id AS b", "id % 3 AS c")
    assert bucket_bounds(df, ["a", "b", "c"], rows_per_bucket=100).width == 2
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b")).cast("long")).select("b", "k").collect()
    got = dense_key(df, ["a", "b", "c"], "k", rows_per_bucket=100).select("b", "k").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("ranged", [False, True])
def test_partitions_of_a_key_grow_with_its_rows(spark, ranged):
    df = spark.range(3000).selectExpr("(id * 7) % 3000 AS a", "id AS b")
    within = (lambda rows, bucket: rows) if ranged else None
    keyed = dense_key(df, ["a"], "k", rows_per_bucket=20, within=within)
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = bucket_bounds(df, ["a"], rows_per_bucket=20).buckets
    wanted = -(-buckets // keys.BUCKETS_PER_PARTITION)
    assert wanted > default
    assert keyed.select(F.spark_partition_id().alias("p")).distinct().count() > default
    assert [r.k for r in keyed.orderBy("a").collect()] == list(range(1, 3001))


def test_measures_do_not_cross_the_shuffle_of_the_fact_key(spark):
    from starloom.plans.facts import sales_fact

    lines = spark.range(40).selectExpr(
        "id AS order_line_id", "id DIV 2 AS order_id", "id % 5 AS product_id", "id % 3 AS customer_id", "id % 3 AS customer_key",
        "id % 5 AS product_key", "id % 2 AS geography_key", "'F' AS order_status", "DATE'2020-01-01' AS order_date",
        "DATE'2020-01-03' AS ship_date", "CAST(3 AS smallint) AS quantity", "CAST(2.50 AS decimal(10,2)) AS unit_price",
        "CAST(10 AS decimal(5,2)) AS discount_pct", "CAST(6.75 AS decimal(10,2)) AS line_total")
    status = spark.createDataFrame([(1, "F")], "order_status_key long, order_status string")
    fact = sales_fact(lines, status)
    below = _plan(fact).split("Exchange", 1)[1]
    assert "gross_sales_amount" not in below and "days_to_ship" not in below
    rows = sorted(fact.select("sales_key", "gross_sales_amount", "discount_amount", "days_to_ship").collect())
    assert [tuple(r) for r in rows] == [(i + 1, Decimal("7.50"), Decimal("0.75"), 2) for i in range(40)]


def test_hash_sums_are_exact_beyond_a_long(spark):
    big = (1 << 60) - 1
    df = spark.range(1000).select(F.lit(big).alias("h"))
    assert df.agg(hash_sum(F.col("h")).alias("s")).first()["s"] == Decimal(big * 1000)
    assert df.where("false").agg(hash_sum(F.col("h")).alias("s")).first()["s"] == 0


def test_orphans_number_the_lines_once(spark, monkeypatch):
    from starloom.queries import fk_orphans

    text = _plan(fk_orphans(spark, "/root/testdata/sf0.001"))
    assert "l_extendedprice" not in text and "l_orderkey" not in text


def test_staged_tables_are_written_with_the_smaller_codec(spark):
    from starloom.sinks.staging import stage

    assert all(f.endswith(".zstd.parquet") for f in stage(spark.range(10).toDF("a"), "codec").inputFiles())


def test_monthly_rows_are_staged_as_narrow_as_the_snapshot(spark, monkeypatch):
    from starloom.plans import snapshot

    staged = {}
    monkeypatch.setattr(snapshot, "stage", lambda df, label: staged.setdefault(label, df))
    lines = spark.sql("""SELECT 1L AS customer_key, 2L AS product_key, 3L AS geography_key, DATE'2020-01-05' AS order_date, id AS order_line_id,
        CAST(2 AS smallint) AS quantity, CAST(1.25 AS decimal(10,2)) AS unit_price, CAST(0 AS decimal(5,2)) AS discount_pct,
        CAST(2.50 AS decimal(10,2)) AS line_total FROM range(3)""")
    row = snapshot.sales_monthly_snapshot(lines).first()
    kinds = dict(staged["monthly"].dtypes)
    assert kinds["net_sales_amount"] == kinds["discount_amount"] == "decimal(12,2)" and kinds["quantity_sold"] == "int"
    assert (row["order_count"], row["quantity_sold"], row["net_sales_amount"], row["ytd_net_sales"]) == (3, 6, Decimal("7.50"), Decimal("7.50"))


def test_rows_are_sorted_by_the_order_before_the_buckets(spark):
    df = spark.range(2000).selectExpr("(id * 7) % 2000 AS a", "id AS b")
    text = _plan(dense_key(df, ["a", "b"], "k", rows_per_bucket=100)).split("Window [", 1)[1].split("Exchange", 1)[0]
    sorts = [line for line in text.split("\n") if "Sort [" in line]
    assert len(sorts) == 2 and "Sort [_sk_bucket" in sorts[0] and "Sort [a#" in sorts[1]


def test_bounds_of_one_column_are_compared_without_tuples(spark):
    df = spark.range(2000).selectExpr("IF(id % 50 = 0, NULL, id) AS a", "CAST(id AS string) AS b")
    bounds = bucket_bounds(df, ["a", "b"], rows_per_bucket=100)
    bucketed = bounds.bucket(df, ["a", "b"], "bucket")
    assert bounds.width == 1 and bounds.buckets > 10
    assert "struct(" not in _plan(bucketed)
    rows = bucketed.orderBy(F.col("a").asc_nulls_first()).collect()
    assert [r.bucket for r in rows] == sorted(r.bucket for r in rows) and {r.bucket for r in rows} == set(range(bounds.buckets))
    want = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b")).cast("long")).collect()
    assert sorted(map(str, dense_key(df, ["a", "b"], "k", rows_per_bucket=100).collect())) == sorted(map(str, want))


def test_a_bound_that_is_null_stays_the_least(spark):
    from pyspark.sql import types as T

    kind = T.ArrayType(T.StructType([T.StructField("c0", T.LongType())]))
    bounds = keys.BucketBounds('[{},{"c0":5}]', kind, 3, 1)
    df = spark.sql("SELECT * FROM VALUES (NULL), (1), (5), (6) AS t(a)").select(F.col("a").cast("long"))
    assert [(r.a, r.bucket) for r in bounds.bucket(df, ["a"], "bucket").orderBy("a").collect()] == [(None, 1), (1, 1), (5, 2), (6, 2)]


_MONTH_LINES = """SELECT 1L AS customer_key, DATE'2020-01-05' AS order_date, id AS order_line_id,
    CAST(CASE WHEN id % 7 = 0 THEN NULL WHEN id % 2 = 0 THEN -32768 ELSE 32767 END AS smallint) AS quantity,
    CAST(CASE WHEN id % 11 = 0 THEN NULL WHEN id % 5 = 0 THEN -99999999.99 ELSE 99999999.97 END AS {price}) AS unit_price,
    CAST(IF(id % 4 = 0, -999.99, 999.97) AS decimal(5,2)) AS discount_pct, CAST(IF(id % 6 = 0, NULL, 0.01 * id) AS decimal(10,2)) AS line_total
    FROM range(200)"""


@pytest.mark.parametrize("price", ["decimal(10,2)", "decimal(12,4)"])
def test_monthly_money_is_summed_exactly(spark, price):
    from decimal import ROUND_HALF_UP

    from starloom.plans.snapshot import monthly_aggregate

    lines = spark.sql(_MONTH_LINES.format(price=price))
    month = monthly_aggregate(lines, ["customer_key"])
    row, rows = month.first(), lines.collect()
    cents = lambda x: x.quantize(Decimal("0.01"), ROUND_HALF_UP)
    sold = [r for r in rows if r.quantity is not None and r.unit_price is not None]
    assert row.gross_sales_amount == cents(sum(r.unit_price * r.quantity for r in sold))
    assert row.discount_amount == cents(sum(r.unit_price * r.quantity * r.discount_pct for r in sold) / 100)
    assert row.net_sales_amount == sum(r.line_total for r in rows if r.line_total is not None)
    if price == "decimal(10,2)":    # partial sums and what is shuffled are longs
        partial = _plan(month).split("Exchange", 1)[1].split("output=", 1)[0] if "output=" in _plan(month) else _plan(month).split("Exchange", 1)[1]
        assert "partial_sum" in partial and not [p for p in partial.split("partial_")[1:] if "/ 100" in p]
        assert dict(month.dtypes)["gross_sales_amount"] == "decimal(27,2)" and dict(month.dtypes)["discount_amount"] == "decimal(31,2)"
        assert dict(month.dtypes)["net_sales_amount"] == "decimal(21,2)"


def test_a_month_without_amounts_has_none(spark):
    from starloom.plans.snapshot import monthly_aggregate

    lines = spark.sql(_MONTH_LINES.format(price="decimal(10,2)")).withColumn("unit_price", F.lit(None).cast("decimal(10,2)"))
    row = monthly_aggregate(lines, ["customer_key"]).first()
    assert row.gross_sales_amount is None and row.discount_amount is None and row.order_count == 200
