import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.schemas import SOURCE_TABLES
from starloom.sources import splits
from starloom.sources.retail import read_retail_source
from starloom.sources.splits import plan_source_splits, plan_splits
from tests.fixtures import retail_fixture


def _database(tables):
    """An in-memory database of this process with the given ``{name: (key, keys)}``."""
    con = duckdb.connect()
    for name, (key, keys) in tables.items():
        con.execute(f"CREATE TABLE {name} ({key} BIGINT)")
        con.executemany(f"INSERT INTO {name} VALUES (?)", [[k] for k in keys] or [[None]])
    return con, lambda q: con.execute(q.replace("FLOOR((", "((").replace(") / ", ") // ").replace("FLOOR(", "(")).fetchall()


def _sizes(con, table, predicates):
    return [con.execute(f"SELECT count(*) FROM {table} WHERE {p}").fetchone()[0] for p in predicates]


def test_splits_of_uneven_keys_cover_every_row_once():
    rnd = random.Random(2)
    keys = list(range(1000)) + [10**12 + k for k in range(3000)] + rnd.sample(range(-(10**15), 0), 500) + [None] * 7
    con, query = _database({"t": ("k", keys)})
    predicates = plan_splits(query, "t", "k", rows_per_split=200)
    sizes = _sizes(con, "t", predicates)
    assert sum(sizes) == len(keys) and max(sizes) <= 210 and 20 <= len(sizes) <= 60
    con.executemany("INSERT INTO t VALUES (?)", [[-(10**17)], [10**17], [None]])  # rows that come later
    assert sum(_sizes(con, "t", predicates)) == len(keys) + 3


def test_one_hot_key_is_a_split_of_its_own_bin():
    con, query = _database({"t": ("k", [5] * 900 + list(range(300)))})
    predicates = plan_splits(query, "t", "k", rows_per_split=100)
    sizes = _sizes(con, "t", predicates)
    assert sum(sizes) == 1200 and sorted(sizes)[-2] <= 110


def test_small_and_empty_tables_are_read_at_once(monkeypatch):
    con, query = _database({"a": ("k", []), "b": ("k", [1, 2])})
    assert plan_splits(query, "a", "k") == ["1 = 1"] and plan_splits(query, "b", "k") == ["1 = 1"]
    monkeypatch.setattr(splits, "MAX_SPLITS", 4)
    con, query = _database({"c": ("k", range(1000))})
    assert len(plan_splits(query, "c", "k", rows_per_split=1)) <= 6


def test_splits_of_all_source_tables():
    rows = {name: 40 * (i + 1) for i, name in enumerate(SOURCE_TABLES)}
    con, query = _database({name: (splits.split_key(name), range(0, 3 * n, 3)) for name, n in rows.items()})
    planned = plan_source_splits(query, rows_per_split=50)
    assert set(planned) == set(SOURCE_TABLES)
    for name, predicates in planned.items():
        sizes = _sizes(con, name, predicates)
        assert sum(sizes) == rows[name] and max(sizes) <= 65, name
        assert all(splits.split_key(name) in p for p in predicates) or rows[name] <= 50


def test_sources_are_read_as_the_model_declares_them(spark, tmp_path):
    """Dates as strings, wider numbers and further columns are taken; what does not fit raises."""
    for name, df in retail_fixture(spark).tables().items():
        wide = df.select(*[F.col(f.name).cast("string" if f.dataType.typeName() in ("date", "long") else "decimal(30,8)"
                                              if f.dataType.typeName() == "decimal" else f.dataType).alias(f.name)
                           for f in reversed(df.schema.fields)], F.lit(1).alias("extra"))
        wide.write.parquet(str(tmp_path / "wide" / name))
    src = read_retail_source(spark, str(tmp_path / "wide"))
    for name, df in src.tables().items():
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in SOURCE_TABLES[name].schema.fields]
    assert src.sales_order.where("order_id = 500").first().order_date == dt.date(2024, 1, 15)
    assert src.product.where("product_id = 50").first().unit_price == Decimal("0.35")

    bad = spark.createDataFrame([("x", "Tools")], "category_id string, category_name string")
    bad.write.mode("overwrite").parquet(str(tmp_path / "wide" / "product_category"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_retail_source(spark, str(tmp_path / "wide")).product_category.collect()
    bad.drop("category_id").write.mode("overwrite").parquet(str(tmp_path / "wide" / "product_category"))
    with pytest.raises(ValueError, match="missing columns"):
        read_retail_source(spark, str(tmp_path / "wide"))


def test_ship_date_may_be_with_the_lines(spark, tmp_path):
    for name, df in retail_fixture(spark).tables().items():
        if name == "sales_order":
            df = df.drop("ship_date")
        if name == "sales_order_line":
            df = df.withColumn("ship_date", F.lit("2024-01-18"))
        df.write.parquet(str(tmp_path / name))
    src = read_retail_source(spark, str(tmp_path))
    assert "ship_date" not in src.sales_order.columns
    assert src.sales_order_line.first().ship_date == dt.date(2024, 1, 18)
