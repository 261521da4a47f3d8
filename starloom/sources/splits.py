"""Plans how a remote table is read in parallel: predicates on its key, one for each task.

Equal key ranges would be uneven where keys lie unevenly (deleted ranges, ids of several
generators). So the database is asked, per table, for the key's span and then for the number of
rows in equal bins of it - two aggregates, whose results are one row and at most ``BINS`` - and the
bins are cut into splits of about equal rows. A bin that holds more than half a split's rows
is binned again, until it is a single key at last (``DEPTH`` levels of bins resolve 64 bits). Predicates cover every value, NULL too, whatever
rows arrive after the plan was made; no row is in two of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from starloom.schemas import SOURCE_TABLES

#: Rows that one task should read; bins of a histogram; how often a bin is binned again; splits of a table at most.
ROWS_PER_SPLIT = 5_000_000
BINS = 1024
DEPTH = 7
MAX_SPLITS = 10_000

Query = Callable[[str], Sequence[Sequence]]


def split_key(table: str) -> str:
    """The column by which a table of the source model is split: its primary key's first."""
    return SOURCE_TABLES[table].primary_key[0]


def _histogram(query: Query, table: str, key: str, low: int, high: int) -> list[tuple[int, int, int]]:
    """``(first key, last key, rows)`` of the bins of ``low .. high`` that hold rows, in order."""
    width = -(-(high - low + 1) // BINS)
    found = query(f"SELECT FLOOR(({key} - ({low})) / {width}) AS bin, COUNT(*) AS n FROM {table} "
                  f"WHERE {key} >= {low} AND {key} <= {high} GROUP BY FLOOR(({key} - ({low})) / {width})")
    return [(low + int(b) * width, min(high, low + (int(b) + 1) * width - 1), int(n)) for b, n in sorted(found)]


def _fine_bins(query: Query, table: str, key: str, low: int, high: int, most: int, depth: int) -> list[tuple[int, int, int]]:
    out = []
    for first, last, rows in _histogram(query, table, key, low, high):
        if rows > most and first < last and depth:
            out += _fine_bins(query, table, key, first, last, most, depth - 1)
        else:
            out.append((first, last, rows))
    return out


def plan_splits(query: Query, table: str, key: str, *, rows_per_split: int = ROWS_PER_SPLIT) -> list[str]:
    """Predicates on the integer ``key`` that part ``table`` into splits of about ``rows_per_split`` rows.

    ``query`` runs a statement in the database and gives its rows. An empty or small
    table has one predicate, which is always true.
    """
    low, high, total = query(f"SELECT MIN({key}), MAX({key}), COUNT(*) FROM {table}")[0]
    if low is None or total <= rows_per_split:
        return ["1 = 1"]
    most = max(rows_per_split, -(-total // MAX_SPLITS))
    cuts, filled = [], 0
    for first, _, rows in _fine_bins(query, table, key, int(low), int(high), max(1, most // 2), DEPTH):
        if filled and filled + rows > most:
            cuts.append(first)
            filled = 0
        filled += rows
    if not cuts:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({key} < {cuts[0]} OR {key} IS NULL)", *inner, f"{key} >= {cuts[-1]}"]


def plan_source_splits(query: Query, *, rows_per_split: int = ROWS_PER_SPLIT,
                       names: Mapping[str, str] | None = None) -> dict[str, list[str]]:
    """Predicates for all twelve source tables (``names``: how the database calls them), for ``read_retail_source``."""
    return {t: plan_splits(query, (names or {}).get(t, t), split_key(t), rows_per_split=rows_per_split) for t in SOURCE_TABLES}


def jdbc_query(spark: SparkSession, url: str, options: Mapping[str, str] | None = None) -> Query:
    """Runs the planner's statements in the database behind a JDBC URL."""
    def query(statement: str) -> Sequence[Sequence]:
        return spark.read.format("jdbc").options(**dict(options or {})).option("url", url).option("query", statement).load().collect()

    return query
