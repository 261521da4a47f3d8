import datetime as dt
import random
from collections import Counter

from starloom.operators import checks
from starloom.operators.checks import (
    column_profile,
    dense_columns,
    duplicate_keys,
    key_violations,
    orphan_counts,
    orphan_rows,
    profile_violations,
)
from starloom.plans.dimensions import customer_dimension
from tests.fixtures import TS, retail_fixture


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a long, b long")
    assert sorted(tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()) == [
        (1, 1, 2), (2, 1, 3)]


def test_duplicate_keys_of_nulls_and_strings(spark):
    rows = [(None, "x")] * 3 + [(1, None)] * 2 + [(1, "x"), (2, "y")]
    df = spark.createDataFrame(rows, "a long, b string")
    assert {tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()} == {(None, "x", 3), (1, None, 2)}


def _plain_violations(rows, at):
    return sum(n > 1 for n in Counter(tuple(r[i] for i in at) for r in rows).values())


def test_key_violations_by_bitmaps_and_hashes(spark):
    rnd = random.Random(3)
    rows = [(i, i * 10**14 - 7, f"n{i % 900}", i // 2, None if i % 50 == 0 else i, -i) for i in range(1000)]
    rows += [(70_000 + i, -(10**17) - i, f"m{i}", 5, 10**6 + i, 5000 + i) for i in range(40)] + rnd.sample(rows, 30)
    df = spark.createDataFrame(rows, "dense long, sparse long, name string, half int, gaps long, minus long").repartition(6)
    keys = [("dense",), ("sparse",), ("name",), ("half",), ("gaps",), ("minus",), ("half", "name")]
    got = {r["key"]: r["violations"] for r in key_violations(df, keys).collect()}
    assert got == {i: _plain_violations(rows, [df.columns.index(c) for c in k]) for i, k in enumerate(keys)}


def test_clean_keys_need_no_exact_count(spark):
    df = spark.range(100_000).selectExpr("id", "concat('k', id) AS name")
    out = key_violations(df, [("id",), ("name",)])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (1, 0)]
    assert "Aggregate" not in out._jdf.queryExecution().toString()


def test_only_suspects_are_counted_exactly(spark):
    """A bitmap of 32,768 keys with one hit twice is counted again, the other tens of them are not."""
    df = spark.range(1_000_000).union(spark.range(500_000, 500_001)).toDF("id")
    suspects = checks.stage

    seen = []
    try:
        checks.stage = lambda frame, label: seen.append(suspects(frame, label)) or seen[-1]
        assert [tuple(r) for r in key_violations(df, [("id",)]).collect()] == [(0, 1)]
    finally:
        checks.stage = suspects
    assert seen[0].count() == 1


def test_orphan_counts_by_bitmap_and_by_key(spark):
    rnd = random.Random(5)
    dense = list(range(0, 70_000, 3))
    sparse = [k * 10**13 for k in range(-20, 20)]
    rows = [(rnd.choice([None, rnd.randrange(-5, 70_100)]), rnd.choice([None, rnd.randrange(-25, 25) * 10**13]), 8) for _ in range(3000)]
    child = spark.createDataFrame(rows, "a long, b long, c int").repartition(5)
    parents = [spark.createDataFrame([(k,) for k in ks], "pk long") for ks in (dense, sparse, [])]
    got = {r["link"]: r["violations"] for r in orphan_counts(child, [("a", parents[0], "pk"), ("b", parents[1], "pk"), ("c", parents[2], "pk")]).collect()}
    assert dense_columns(parents[0], ["pk"]) == {"pk"} and not dense_columns(parents[1], ["pk"]) and not dense_columns(parents[2], ["pk"])
    assert got == {0: sum(r[0] is not None and r[0] not in set(dense) for r in rows),
                   1: sum(r[1] is not None and r[1] not in set(sparse) for r in rows), 2: 3000}
    assert orphan_counts(child.limit(0), [("a", parents[0], "pk")]).collect() == [(0, 0)]


def test_orphans_skip_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12)], "id long, fk long")
    parent = spark.createDataFrame([(10,), (12,)], "pk long")
    got = orphan_rows(child, parent, ["fk"], ["pk"], keep=["id"]).collect()
    assert [(r.id, r.fk) for r in got] == [(2, 11)]


def test_width_and_not_null_profile(spark):
    long_first, long_last = "F" * 100, "L" * 100
    customers = [(1, long_first, long_last, "x@example.org", None, dt.date(1980, 1, 1), 1000, TS),
                 (2, "Bo", "Ng", "bo@example.org", None, None, 1001, TS)]
    src = retail_fixture(spark, customers=customers)
    dim = customer_dimension(src, dt.date(2024, 12, 31))
    from starloom.schemas import DIM_CUSTOMER
    prof = {r.column_name: r for r in column_profile(dim, DIM_CUSTOMER).collect()}
    assert prof["full_name"].over_width_count == 1 and prof["full_name"].max_length == 201
    assert prof["phone"].null_count == 2 and prof["phone"].declared_not_null == 0
    bad = [r.column_name for r in profile_violations(column_profile(dim, DIM_CUSTOMER)).collect()]
    assert bad == ["full_name"]
