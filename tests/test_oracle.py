"""Every registered query against its DuckDB statement on the sf0.001 tables."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.oracle import ORACLE_SQL
from starloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.000001")))
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
         "date": "DATE", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sdf.columns == rel.columns
    spark_types = [_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in sdf.schema.fields]
    assert spark_types == [str(t) for t in rel.types]
    got = Counter(tuple(_norm(v) for v in r) for r in sdf.collect())
    exp = Counter(tuple(_norm(v) for v in r) for r in rel.fetchall())
    assert got == exp


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 100
    assert len(df.columns) == 23
