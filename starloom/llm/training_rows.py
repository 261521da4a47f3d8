"""Bounded samples of labelled rows for the trained classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, *, rows_per_class: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows_per_class`` labelled documents of either class.

    ``keep`` is a condition on ``doc_id`` that holds for the rows that may be
    learned from. The rows with the smallest hash of their id are taken, so the
    sample does not depend on partitioning; labels of ids that ``docs`` lacks do
    not use up the bound. An id labelled more than once counts
    by its largest label; rows with a null id, null label or a label other than
    0 and 1 are not learned from. The ids (at most ``2 * rows_per_class`` of
    them) are broadcast; only the sample's texts leave the scan.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("label") == k).orderBy(order, "doc_id").limit(rows_per_class) for k in (0, 1)]
    ids = parts[0].unionByName(parts[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(ids), "doc_id")


