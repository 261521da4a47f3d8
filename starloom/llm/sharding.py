"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents of equal text form a group, which stays together. The law is
``bytes``: the shards' summed sizes are as near to equal as differencing gets
them; a group larger than a shard's fair share makes its shard the larger one.

A partial partition is a vector of ``shards`` sums. Differencing takes the two
with the largest spread (largest less smallest sum), adds them oppositely
ordered, so the largest parts of one meet the smallest of the other, and puts
the sum back, until one is left. That is done as a tree over Spark tasks: groups
are dealt by hash to buckets of about ``FAN_IN``, each bucket is differenced to
one vector in its task, then vectors are differenced ``FAN_IN`` at a time, level
by level. Only a level's permutations (``shards`` rows a member) flow back.

Slots are gapless in a shard without ordering it in one task: rows are dealt to
slices by hash, slices are numbered by their counts, rows within a slice.

Defined results: a null text has no bytes and belongs with the empty texts;
repeated rows each take a slot; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.sinks.staging import stage

SHARDS = 40
OVERHEAD = 16
FAN_IN = 4096
SLICE_ROWS = 50_000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, sums)``: the part of the whole that each part of each vector goes to, and the whole's sums.

    ``vectors`` has a row for each member and a column for each part.
    """
    n, parts = vectors.shape
    first = np.argsort(-vectors, axis=1, kind="stable")            # position -> part, largest first
    sums: list[np.ndarray | None] = list(np.take_along_axis(vectors, first, 1))
    made: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(v[0] - v[-1]), k) for k, v in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        made.append((a, b, order))
        sums[a] = sums[b] = None
        sums.append(total)
        heapq.heappush(heap, (-int(total[0] - total[-1]), len(sums) - 1))
    place: list[np.ndarray | None] = [None] * len(sums)
    place[-1] = np.arange(parts)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, order = made[node - n]
        at = place[node]
        back = np.empty(parts, np.int64)
        back[order] = at                                           # position before sorting -> place
        place[a], place[b], place[node] = back, back[::-1], None
    out = np.empty((n, parts), np.int64)
    np.put_along_axis(out, first, np.stack(place[:n]), 1)
    return out, sums[-1]


def _groups_to_parts(groups: DataFrame, shards: int) -> DataFrame:
    """``digest``, ``bucket``, ``part`` and ``bytes`` of each group, differenced within its bucket."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("digest", "ascending")])
        size = table["bytes"].to_numpy()
        vectors = np.zeros((len(size), shards), np.int64)
        vectors[:, 0] = size
        part = difference(vectors)[0][:, 0]
        return table.append_column("part", pa.array(part.astype(np.int32)))

    return groups.select("digest", "bucket", "bytes").groupBy("bucket").applyInArrow(
        run, "digest binary, bucket long, bytes long, part int")


def _merge_level(sums: DataFrame, shards: int, fan_in: int) -> DataFrame:
    """``bucket``, ``part`` and where they go: ``up`` (the next bucket) and ``to`` (its part), with ``bytes``."""
    def run(table: pa.Table) -> pa.Table:
        bucket, part, size = (table[c].to_numpy() for c in ("bucket", "part", "bytes"))
        ids, row = np.unique(bucket, return_inverse=True)
        vectors = np.zeros((len(ids), shards), np.int64)
        vectors[row, part] = size
        place = difference(vectors)[0]
        return pa.table({"bucket": np.repeat(ids, shards), "part": np.tile(np.arange(shards, dtype=np.int32), len(ids)),
                         "up": np.repeat(ids // fan_in, shards), "to": place.ravel().astype(np.int32),
                         "bytes": vectors.ravel()})

    return (sums.withColumn("up", F.floor(F.col("bucket") / fan_in).cast("long")).groupBy("up")
            .applyInArrow(run, "bucket long, part int, up long, to int, bytes long"))


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, fan_in: int = FAN_IN,
                    slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every document."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.unhex(F.sha2(data, 256)).alias("digest")), "shard-rows")
    groups = stage(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    buckets = max(1, -(-groups.count() // fan_in))
    placed = stage(_groups_to_parts(
        groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("long")), shards), "shard-parts")
    sums = placed.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))
    placed = placed.select("digest", "bucket", "part")
    while buckets > 1:
        level = stage(_merge_level(sums, shards, fan_in), "shard-level")
        placed = (placed.join(level.select("bucket", "part", "up", "to"), ["bucket", "part"])
                  .select("digest", F.col("up").alias("bucket"), F.col("to").alias("part")))
        sums = level.groupBy(F.col("up").alias("bucket"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
        buckets = -(-buckets // fan_in)

    slices = max(1, -(-rows.count() // slice_rows))
    dealt = stage(rows.join(placed.select("digest", F.col("part").alias("shard")), "digest")
                  .withColumn("slice", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(slices)).cast("int")), "shard-dealt")
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("rows"))
              .select("shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "digest")
    return (dealt.withColumn("place", F.row_number().over(within) - 1).join(counts, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("place")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
