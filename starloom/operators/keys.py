"""Surrogate keys and key resolution.

``dense_key`` numbers rows 1..N in a total order by one recipe at every size:

1. a quantile sketch of the order tuples - those whose hash lies under a threshold, a sample that
   merges over tasks and does not depend on partitioning - gives literal bucket bounds;
2. a row's bucket is found by binary search in the bounds (built-in expressions only);
3. the buckets' row counts are summed up into offsets (one row per bucket);
4. ``row_number()`` within the bucket plus the bucket's offset is the key.

Bounds are over as many leading columns as tell them apart, so a hot leading value is split over buckets, and
an order whose first column has no hot value is dealt by that column alone. They only
decide how evenly rows are dealt: counts are exact, so any bounds give the same keys. The plan is lazy
and has one shuffle of the rows; buckets are functions of the row alone, so a lost
executor's tasks can be run again. Nothing is written.

The order must be total (unique order columns); otherwise ties are numbered
in an arbitrary, run-dependent way. NULLs come first, as in ``ORDER BY``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.bounds import keep_rows, known_rows_exactly

ColumnLike = Column | str

#: Rows of a bucket, about; buckets at most (then they grow); sampled tuples of a bucket.
ROWS_PER_BUCKET = 1 << 16
MAX_BUCKETS = 1 << 13
TUPLES_PER_BUCKET = 16
#: Buckets of a partition, about, where ``spark.sql.shuffle.partitions`` is too few for the rows.
BUCKETS_PER_PARTITION = 8

_HASHES = 1 << 53  # exact as doubles


def _cols(cols: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _tuple(cols: Sequence[ColumnLike]) -> Column:
    return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(_cols(cols))])


@dataclass(frozen=True)
class BucketBounds:
    """Least tuples of the buckets 1, 2, ... as JSON; tuples below them all are in bucket 0.

    They have the first ``width`` of the order columns; rows equal in these share a bucket.
    """

    json: str
    type: T.DataType
    buckets: int
    width: int

    def bucket(self, df: DataFrame, cols: Sequence[ColumnLike], name: str) -> DataFrame:
        """``df`` with the bucket of each row: the number of bounds that are not above its tuple.

        One projection per halving; each compares the row's tuple with one
        element of a literal array. The array is sorted again after parsing, so
        that even a value that JSON had changed would leave buckets in order.
        Bounds of one column are compared as plain values, as building a tuple in every
        halving takes several times as long; a bound that is NULL needs tuples, where it is the least.
        """
        bounds = F.sort_array(F.from_json(F.lit(self.json), self.type))
        own = _tuple(cols[:self.width])
        if self.width == 1 and "{}" not in self.json:       # JSON leaves a NULL out; a row's NULL reaches no bound
            bounds, own = bounds.getField(self.type.elementType.names[0]), _cols(cols[:1])[0]
        out = df.withColumn(name, F.lit(0))
        for k in reversed(range((self.buckets - 1).bit_length())):
            reached = F.col(name) + F.lit(1 << k)
            out = out.withColumn(name, F.when(F.get(bounds, reached - 1) <= own, reached).otherwise(F.col(name)))
        return out


def bucket_bounds(df: DataFrame, cols: Sequence[ColumnLike], *, size_of: DataFrame | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET, max_buckets: int = MAX_BUCKETS) -> BucketBounds:
    """Bounds that deal ``df`` evenly by its ``cols`` (two small jobs: a count and the sketch).

    ``size_of`` is a cheaper frame to count, of about as many rows (a dimension's base
    table): it only sets the sampling share. The sketch is held to ``max_buckets *
    TUPLES_PER_BUCKET`` tuples, those of the smallest hashes, whatever was
    counted; the bounds, at most ``max_buckets``, are all that reaches the driver.
    """
    rows = (df if size_of is None else size_of).count()
    wanted = min(max_buckets, max(1, math.ceil(rows / rows_per_bucket)))
    kind = df.select(_tuple(cols).alias("t")).schema["t"].dataType
    if wanted == 1:
        return BucketBounds("[]", T.ArrayType(kind), 1, len(kind.fields))
    hashed = F.pmod(F.xxhash64(*_cols(cols)), F.lit(_HASHES))
    share = min(1.0, wanted * TUPLES_PER_BUCKET / rows)
    sketch = (df.select(_tuple(cols).alias("t"), hashed.alias("h")).where(F.col("h") < F.lit(int(_HASHES * share)))
              .orderBy("h").limit(max_buckets * TUPLES_PER_BUCKET))
    listed = (sketch.agg(F.sort_array(F.collect_list("t")).alias("t"))
              .withColumn("n", F.greatest(F.lit(1), F.ceil(F.size("t") / TUPLES_PER_BUCKET))))
    place = lambda i: F.floor(i * F.col("n") / F.size("t"))
    first = listed.select(F.array_distinct(F.filter("t", lambda _, i: (i > 0) & (place(i) > place(i - 1)))).alias("t"))
    # The fewest leading columns in which neighbouring bounds differ: a value that fills a bucket is in two bounds.
    lead = lambda t, k: F.struct(*[t[c].alias(c) for c in kind.names[:k]])
    alike = lambda k: F.filter("t", lambda t, i: (i > 0) & lead(t, k).eqNullSafe(lead(F.get("t", i - 1), k)))
    width = F.coalesce(*[F.when(F.size(alike(k)) == 0, F.lit(k)) for k in range(1, len(kind.names))], F.lit(len(kind.names)))
    json = F.lit(None).cast("string")
    for k in range(1, len(kind.names) + 1):
        json = F.when(F.col("width") == k, F.to_json(F.transform("t", lambda t: lead(t, k)))).otherwise(json)
    found = first.withColumn("width", width).select(json.alias("json"), F.size("t").alias("n"), "width").first()
    return BucketBounds(found["json"], T.ArrayType(T.StructType(kind.fields[:found["width"]])), found["n"] + 1, found["width"])


def dense_key(df: DataFrame, order_cols: Sequence[ColumnLike], name: str, *,
              range_cols: Sequence[ColumnLike] | None = None,
              size_of: DataFrame | None = None,
              rows_per_bucket: int | None = None,
              within: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Dense key 1..N in ``order_cols`` order.

    ``df`` is evaluated three times, twice with its order columns alone; a costly
    one should be staged by the caller. ``range_cols`` (default: ``order_cols``) must be a
    leading prefix of ``order_cols``: rows equal in them share a bucket, so ``within`` -
    a transformation ``(rows, bucket column)`` that keeps the number of rows - can run windows
    that are partitioned by the bucket and those columns without another shuffle.
    ``size_of``: see ``bucket_bounds``.

    Without ``within`` the result's partitions are runs of buckets, in order, so a table that is written from it has
    files that follow each other in ``order_cols``. There are ``spark.sql.shuffle.partitions`` of them, or fewer; where these
    would hold more than ``BUCKETS_PER_PARTITION`` buckets, there are more, so that a task's rows do not grow with the table.
    """
    by = range_cols or order_cols
    bounds = bucket_bounds(df, by, size_of=size_of, rows_per_bucket=rows_per_bucket or ROWS_PER_BUCKET)
    bucketed = bounds.bucket(df, by, "_sk_bucket")
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = math.ceil(bounds.buckets / BUCKETS_PER_PARTITION)
    if within is None:
        parts = min(bounds.buckets, max(default, needed))
        run = F.floor(F.col("_sk_bucket") * F.lit(parts) / F.lit(bounds.buckets)).cast("int")
        # Spark sorts by prefixes of the first column alone, which tell rows apart where it is the order's own, not
        # the bucket that the window puts first. What is sorted already costs the window's sort one comparison a row.
        dealt = bucketed.withColumn("_sk_run", run).repartitionById(parts, "_sk_run").sortWithinPartitions(*_cols(order_cols))
        rows, by_bucket = dealt, ["_sk_bucket", "_sk_run"]
    else:
        dealt = bucketed.repartition(needed, "_sk_bucket") if needed > default else bucketed.repartition("_sk_bucket")
        rows, by_bucket = within(dealt, "_sk_bucket"), ["_sk_bucket"]
    place = F.row_number().over(Window.partitionBy(*by_bucket).orderBy(*_cols(order_cols)))
    placed = rows.withColumn("_sk_place", place).drop("_sk_run")
    if bounds.buckets == 1:  # there is no earlier bucket
        return placed.withColumn(name, F.col("_sk_place").cast("long")).drop("_sk_bucket", "_sk_place")
    counts = bucketed.groupBy("_sk_bucket").agg(F.count(F.lit(1)).alias("_sk_rows"))
    # One row per bucket, so the running sum over all of them is bounded, and so is the broadcast.
    earlier = Window.orderBy("_sk_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_sk_bucket", F.coalesce(F.sum("_sk_rows").over(earlier), F.lit(0)).alias("_sk_offset"))
    keyed = placed.join(F.broadcast(offsets), "_sk_bucket")
    return keyed.withColumn(name, (F.col("_sk_offset") + F.col("_sk_place")).cast("long")).drop("_sk_bucket", "_sk_place", "_sk_offset")


#: A lookup is broadcast if it has at most so many rows and bytes. Both are measured.
SMALL_LOOKUP_MAX_ROWS = 100_000
SMALL_LOOKUP_MAX_BYTES = 16 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row of ``df`` takes in memory: 8 a column, plus the bytes of strings and nested values."""
    parts = [F.lit(8 * len(df.columns)).cast("long")]
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("long"))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)).cast("long"))
    return sum(parts[1:], parts[0])


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Takes the byte sizes of at most ``max_rows + 1`` rows: ``take`` scans
    partitions incrementally and stops once it has enough, so a huge table
    costs a few partitions, not a full pass, and only that many integers reach
    the driver. A row count that is already known to be too large needs no job.
    """
    known = known_rows_exactly(df)
    if known is not None and known > max_rows:
        return False
    sizes = [r[0] for r in df.select(row_bytes(df)).take(max_rows + 1)]
    return len(sizes) <= max_rows and sum(sizes) <= max_bytes


def small_lookup(df: DataFrame, max_rows: int = SMALL_LOOKUP_MAX_ROWS, max_bytes: int = SMALL_LOOKUP_MAX_BYTES) -> DataFrame:
    """``df`` marked for broadcast when its measured rows and bytes are within the bounds (``fits_broadcast``).

    Over a bound the frame is returned unmarked and the planner picks a shuffle join (AQE splits
    skewed keys).
    Use for lookups with few distinct keys (statuses, cities, brands): a
    shuffle join on such a key would put huge groups of the large side into
    a few tasks, and AQE only turns it into a broadcast after the large side
    has already been shuffled.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def current_rows(dim: DataFrame) -> DataFrame:
    """Rows of a versioned dimension that are current (``is_current = 1``)."""
    if "is_current" in dim.columns:
        return dim.where(F.col("is_current") == 1)
    return dim


def resolve_key(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]],
                key: str, *, keep: Sequence[str] = (), small: bool = False) -> DataFrame:
    """Inner-join ``df`` to the current rows of ``dim`` and add ``dim.key``.

    ``on`` pairs a column of ``df`` with a natural-key column of ``dim``. Rows
    of ``df`` without a match are dropped, as an inner join does. ``keep``
    names further ``dim`` columns to carry along. With ``small`` the lookup
    is broadcast after its size is checked (``small_lookup``); otherwise the
    planner picks the join strategy from size statistics (and AQE from
    measured sizes at run time).
    """
    wanted = [key, *keep]
    right_cols = [r for _, r in on]
    lookup = current_rows(dim).select(
        *[F.col(r).alias(f"_rk_{i}") for i, r in enumerate(right_cols)],
        *[F.col(c) for c in wanted])
    if "is_current" not in dim.columns:
        keep_rows(dim, lookup)   # a projection
    cond = None
    for i, (left, _) in enumerate(on):
        term = F.col(left) == F.col(f"_rk_{i}")
        cond = term if cond is None else cond & term
    if small:
        lookup = small_lookup(lookup)
    joined = df.join(lookup, cond, "inner")
    return joined.drop(*[f"_rk_{i}" for i in range(len(on))])
