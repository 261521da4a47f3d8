"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.sinks.staging import stage


def _staged(edges: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """The edges, written and read again, with their number and a sum of their hashes."""
    seen = Observation()
    digest = F.xxhash64("u", "v").cast("decimal(38,0)")
    out = stage(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(digest).alias("h")), label)
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (``a``, ``b`` long); a component is its smallest node.

    Alternates two contractions until nothing changes: every node's larger
    neighbours, then its smaller ones, are tied to its smallest neighbour. The
    rounds grow with the logarithm of the graph, a node's neighbours are only
    ever reduced to a minimum (with partial aggregation) and joined back, so a
    hub is never gathered in a task. Each round's edges are written to the
    shared checkpoint folder, which cuts the lineage. Self loops and rows with
    nulls are no edges.
    """
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e, seen = _staged(e, label)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = (tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        e, now = _staged(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
