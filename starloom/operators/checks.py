"""Integrity checks for declared-but-unenforced constraints.

Spark file tables do not enforce primary, unique or foreign keys, NOT NULL or
VARCHAR widths. These operators scan at full scale and return the violations
(or a per-column profile) as a DataFrame; no data rows go to the driver.

``declared_key_violations`` reads a table once for all its keys and once for all its foreign
keys, whatever their number:

* A key is first counted by slots. Integers that lie densely (surrogate keys, date keys)
  have one bit each in a bitmap of 32,768 (``bitmap_construct_agg``): a bitmap with as many bits as rows
  proves all of them unique, at a bit a row. Other keys, composite ones too, are counted by their 64-bit hash. Only rows in slots that
  were hit twice go on to the exact count.
* A foreign key is checked against its parent's bitmaps, joined by bucket to the child's distinct keys with their
  row counts; a bucket has at most 32,768 keys, so no join key is hot. Parents with sparse integers are joined by
  the key itself in the same join. Keys that are no single integer take an anti join.

Whether integers lie densely is measured (minimum, maximum and number, which Parquet footers can answer), so a
bitmap never takes more than ``BITS_PER_KEY`` bits a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.bounds import known_rows_exactly
from starloom.operators.keys import SMALL_LOOKUP_MAX_ROWS
from starloom.schemas import Table
from starloom.sinks.staging import stage

#: A bitmap is used where it takes at most so many bits for each key (a key itself has 64).
BITS_PER_KEY = 64
BITMAP_BITS = 1 << 15
_NO_SLOT = -(1 << 62)


def duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count.

    Rows are first counted by the 64-bit hash of their key, whatever its width, with
    partial counts per task; only rows whose hash occurs again are grouped by the key itself.
    NULL is a value like others.
    """
    slot = F.xxhash64(*key_cols)
    again = df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_slot")
    return _exact_duplicates(df, key_cols, slot, again)


def _exact_duplicates(df: DataFrame, key_cols: Sequence[str], slot: Column, suspects: DataFrame) -> DataFrame:
    rows = df.select(*key_cols, slot.alias("_slot")).join(suspects, "_slot", "left_semi")
    return (rows.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def orphan_rows(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                parent_cols: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (left anti join).

    A foreign key with any NULL part is not checked, as in SQL. ``keep`` names
    extra child columns to return beside the key (for example the child's
    primary key). A parent that is known to have few rows (a calendar, a
    status list) is broadcast, so the child is scanned, not shuffled; other
    parents are left to the planner.
    """
    parent_keys = parent.select(*[F.col(p).alias(f"_pk_{i}") for i, p in enumerate(parent_cols)])
    rows = known_rows_exactly(parent)
    if rows is not None and rows <= SMALL_LOOKUP_MAX_ROWS:
        parent_keys = F.broadcast(parent_keys)
    cond = None
    present = None
    for i, c in enumerate(child_cols):
        term = F.col(c) == F.col(f"_pk_{i}")
        cond = term if cond is None else cond & term
        nn = F.col(c).isNotNull()
        present = nn if present is None else present & nn
    cols = list(dict.fromkeys([*keep, *child_cols]))
    return child.select(*cols).where(present).join(parent_keys, cond, "left_anti")


def column_profile(df: DataFrame, table: Table,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs in NOT NULL columns and over-wide strings, in one pass.

    Returns one row per checked column: ``column_name``, ``declared_not_null``
    (1/0), ``null_count``, ``declared_width`` (NULL when undeclared),
    ``over_width_count`` and ``max_length``. Counts are over the whole table.
    """
    names = list(columns) if columns is not None else table.columns
    not_null = set(table.not_null)
    widths: Mapping[str, int] = table.widths
    aggs = []
    for i, c in enumerate(names):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        if c in widths:
            aggs.append(F.count_if(F.length(F.col(c)) > widths[c]).alias(f"w{i}"))
            aggs.append(F.max(F.length(F.col(c))).alias(f"m{i}"))
    one_row = df.agg(*aggs)
    rows = []
    for i, c in enumerate(names):
        has_w = c in widths
        rows.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(1 if c in not_null else 0).alias("declared_not_null"),
            F.col(f"n{i}").cast("long").alias("null_count"),
            (F.lit(widths[c]) if has_w else F.lit(None)).cast("int").alias("declared_width"),
            (F.col(f"w{i}") if has_w else F.lit(0)).cast("long").alias("over_width_count"),
            (F.col(f"m{i}") if has_w else F.lit(None)).cast("int").alias("max_length"),
        ))
    return (one_row.select(F.inline(F.array(*rows)))
            .select(F.lit(table.name).alias("table_name"), "*"))


def profile_violations(profile: DataFrame) -> DataFrame:
    """Rows of ``column_profile`` that break a declared constraint."""
    return profile.where(((F.col("declared_not_null") == 1) & (F.col("null_count") > 0))
                         | (F.col("over_width_count") > 0))


def _is_integer(df: DataFrame, cols: Sequence[str]) -> bool:
    return len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def dense_columns(df: DataFrame, cols: Sequence[str]) -> set[str]:
    """Those of the integer columns whose values lie densely enough for a bitmap (one scan of them, one row)."""
    cols = list(dict.fromkeys(cols))
    if not cols:
        return set()
    row = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    return {c for i, c in enumerate(cols) if row[f"n{i}"] and row[f"hi{i}"] - row[f"lo{i}"] < BITS_PER_KEY * row[f"n{i}"]}


def _bucket(key: Column) -> Column:
    return F.bitmap_bucket_number(key.cast("long"))


def _bit(key: Column) -> Column:
    return F.bitmap_bit_position(key.cast("long"))


def _key_slots(df: DataFrame, keys: Sequence[Sequence[str]]) -> list[tuple[Column, Column]]:
    """Of each key its slot, and its bit in the slot's bitmap (NULL: the slot is the hash of one key)."""
    dense = dense_columns(df, [k[0] for k in keys if _is_integer(df, k)])
    return [(F.coalesce(_bucket(F.col(k[0])), F.lit(_NO_SLOT)), _bit(F.col(k[0]))) if len(k) == 1 and k[0] in dense
            else (F.xxhash64(*k), F.lit(None).cast("long")) for k in keys]


def key_violations(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """``(key, violations)``: for each of ``keys``, by its place, the number of values that occur more than once.

    One scan counts all keys by slots; a key without slots that were hit twice needs no more.
    The slots hit twice are written once, as the exact counts of several keys read them.
    """
    slots = _key_slots(df, keys)
    each = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("key"), s.alias("slot"), b.alias("bit"))
                                         for i, (s, b) in enumerate(slots)])).alias("s")).select("s.*")
    hashed = each.where(F.col("bit").isNull()).groupBy("key", "slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    mapped = (each.where(F.col("bit").isNotNull()).groupBy("key", "slot")
              .agg(F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg("bit")).alias("bits"))
              .where(F.col("n") > F.col("bits")))
    suspects = stage(hashed.select("key", "slot").union(mapped.select("key", "slot")), "key-suspects")
    open_keys = {r["key"] for r in suspects.select("key").distinct().collect()}
    out = df.sparkSession.createDataFrame([(i, 0) for i in range(len(keys)) if i not in open_keys], "key int, violations long")
    for i in sorted(open_keys):
        of_key = suspects.where(F.col("key") == i).select(F.col("slot").alias("_slot"))
        twice = _exact_duplicates(df, keys[i], slots[i][0], of_key)
        out = out.unionByName(twice.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(i).alias("key"), "violations"))
    return out


def orphan_counts(child: DataFrame, links: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``(link, violations)``: for each ``(child column, parent, parent column)`` the child rows without a parent row.

    All columns must be integers; a NULL is not checked. The child is scanned once for all links.
    """
    fields, parents = [], None
    measured: dict[tuple[int, str], bool] = {}
    for i, (col, parent, pk) in enumerate(links):
        if (id(parent), pk) not in measured:
            measured[id(parent), pk] = pk in dense_columns(parent, [pk])
        dense = measured[id(parent), pk]
        key = F.col(col).cast("long")
        fields.append(F.struct(F.lit(i).alias("link"), key.alias("key"), (_bucket(key) if dense else key).alias("slot")))
        known = parent.where(F.col(pk).isNotNull()).select(F.col(pk).cast("long").alias("pk"))
        if dense:
            known = known.groupBy(_bucket(F.col("pk")).alias("slot")).agg(F.bitmap_construct_agg(_bit(F.col("pk"))).alias("bits"))
        else:
            known = known.select(F.col("pk").alias("slot"), F.lit(None).cast("binary").alias("bits")).distinct()
        known = known.select(F.lit(i).alias("link"), "slot", "bits", F.lit(True).alias("there"))
        parents = known if parents is None else parents.unionByName(known)
    used = (child.select(F.explode(F.array(*fields)).alias("f")).select("f.*").where(F.col("key").isNotNull())
            .groupBy("link", "slot", "key").agg(F.count(F.lit(1)).alias("n")))
    bit = _bit(F.col("key"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (bit % 8).cast("int")) == 1
    found = F.coalesce(F.col("there"), F.lit(False)) & F.coalesce(F.when(F.col("bits").isNotNull(), marked), F.lit(True))
    counted = (used.join(parents, ["link", "slot"], "left").groupBy("link")
               .agg(F.sum(F.when(found, 0).otherwise(F.col("n"))).alias("violations")))
    every = child.sparkSession.range(len(links)).select(F.col("id").cast("int").alias("link"))
    return every.join(counted, "link", "left").select("link", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def declared_key_violations(tables: Mapping[str, DataFrame],
                            definitions: Mapping[str, Table]) -> DataFrame:
    """Check every declared primary, unique and foreign key among ``tables``.

    Returns one row per constraint: ``constraint_name``, ``kind``
    (``primary``/``unique``/``foreign``) and ``violations`` (duplicated key
    values, or orphan rows). Foreign keys whose parent is not in ``tables``
    are skipped. Tables should be written ones: a table is scanned once for its keys, once for its
    foreign keys and once as a parent. Only the per-constraint counts leave the executors.
    """
    parts = []

    def named(counts: DataFrame, place: str, names: Sequence[tuple[str, str]]) -> DataFrame:
        name, kind = (F.element_at(F.array(*[F.lit(n[k]) for n in names]), F.col(place) + 1) for k in (0, 1))
        return counts.select(name.alias("constraint_name"), kind.alias("kind"), "violations")

    for name, df in tables.items():
        t = definitions[name]
        keys = ([("primary", t.primary_key)] if t.primary_key else []) + [("unique", u) for u in t.unique]
        if keys:
            parts.append(named(key_violations(df, [cols for _, cols in keys]), "key",
                               [(f"{name}({', '.join(cols)})", kind) for kind, cols in keys]))
        by_bitmap = []
        for cols, parent, parent_cols in t.foreign_keys:
            if parent not in tables:
                continue
            label = f"{name}({', '.join(cols)}) -> {parent}"
            if _is_integer(df, cols) and _is_integer(tables[parent], parent_cols):
                by_bitmap.append((label, (cols[0], tables[parent], parent_cols[0])))
            else:
                orphans = orphan_rows(df, tables[parent], cols, parent_cols)
                parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(label).alias("constraint_name"), F.lit("foreign").alias("kind"), "violations"))
        if by_bitmap:
            parts.append(named(orphan_counts(df, [link for _, link in by_bitmap]), "link", [(n, "foreign") for n, _ in by_bitmap]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
