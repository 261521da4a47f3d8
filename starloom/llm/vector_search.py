"""Approximate nearest neighbours over balanced posting lists.

* Lists: balanced two-means splits, over and over, of a bounded sample
  (``SAMPLE_ROWS`` vectors with the smallest id hash) give lists of nearly equal
  size; a list's centroid is the mean of its part. There is a list for about
  ``LIST_SIZE`` vectors, ``MOST_LISTS`` at most, so the centroids fit in memory.
* Centroids are found by best-first search in an in-memory graph: every centroid
  is tied to its nearest others and to some at random.
* Every vector goes to its nearest list, and a vector near a boundary also to
  those hardly farther (``REPLICA_RATIO``), ``MOST_REPLICAS`` lists at most.
* A query reads the lists whose centroid is within a ratio of the distance of
  its nearest centroid, and on, nearest first, until they hold enough rows. The
  ratio is the one that reaches ``TARGET`` recall among the sample: vectors of it
  ask for their true neighbours in it, found by brute force.

Equal vectors are one: of those with the same components only the ``k + 1``
smallest ids can be in any answer, and their queries have one search. Long lists
are cut into blocks of ``BLOCK_ROWS`` by hash, which all queries of the list
read. In a block, distances are matrix products in double precision; the answers'
are taken again from the original components.

Defined results: vectors that are null, zero, or hold a null or non-finite
component take no part, neither do those of another dimension than most of the
sample's, nor rows with a null id. Rows that repeat an id are one candidate for each
different vector, by its nearest. With fewer candidates than ``k`` all are given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.sinks.staging import stage

K = 10
SAMPLE_ROWS = 40_000
LIST_SIZE = 512
MOST_LISTS = 4096
NEIGHBOURS = 16
REPLICA_RATIO = 1.05
MOST_REPLICAS = 4
TARGET = 0.97
BEAM = 256
BLOCK_ROWS = 4096
LEAST_READ = 64


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Means of ``lists`` parts of nearly equal size."""
    rng = np.random.default_rng(seed)
    out, work = [], [(np.arange(len(x)), lists)]
    while work:
        rows, n = work.pop()
        if n <= 1 or len(rows) <= 1:
            out.append(x[rows].mean(0))
            continue
        part = x[rows]
        a, b = part[rng.choice(len(rows), 2, replace=False)]
        left = n // 2
        cut = min(max(1, round(len(rows) * left / n)), len(rows) - 1)
        for _ in range(8):
            lean = part @ (b - a) * 2 - (b @ b - a @ a)        # larger: nearer to b
            order = np.argsort(lean, kind="stable")
            a, b = part[order[:cut]].mean(0), part[order[cut:]].mean(0)
        work += [(rows[order[:cut]], left), (rows[order[cut:]], n - left)]
    return np.stack(out)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(-1)[:, None] - 2 * x @ y.T + (y * y).sum(-1)[None, :], 0)


@dataclass
class CentroidGraph:
    """Centroids, the neighbours of each, and some entry points."""

    centroids: np.ndarray
    near: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray, seed: int = 2) -> CentroidGraph:
        rng, n = np.random.default_rng(seed), len(centroids)
        near = np.empty((n, min(n, NEIGHBOURS + 1)), np.int64)
        for a in range(0, n, 512):
            near[a:a + 512] = np.argsort(_squares(centroids[a:a + 512], centroids), axis=1)[:, :near.shape[1]]
        far = rng.integers(0, n, (n, 4))
        return cls(centroids, np.concatenate([near, far], 1), rng.choice(n, min(n, 8), replace=False))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """``(centroid, distance)`` of the nearest found for each row, nearest first; best-first for all rows together."""
        n, q = len(self.centroids), len(x)
        beam = min(beam, n)
        if n <= 2 * beam:
            d = _squares(x, self.centroids)
            order = np.argsort(d, axis=1, kind="stable")[:, :beam]
            return order, np.sqrt(np.take_along_axis(d, order, 1))
        rows = np.arange(q)[:, None]
        seen = np.zeros((q, n), bool)
        ids = np.full((q, beam), 0)
        dist = np.full((q, beam), np.inf)
        done = np.ones((q, beam), bool)
        fresh = np.broadcast_to(self.entries, (q, len(self.entries)))
        while True:
            first = ~seen[rows, fresh]
            # a node named twice in one step counts once
            order = np.argsort(fresh, axis=1, kind="stable")
            s = np.take_along_axis(fresh, order, 1)
            twice = np.zeros_like(first)
            np.put_along_axis(twice, order[:, 1:], s[:, 1:] == s[:, :-1], 1)
            first &= ~twice
            seen[rows, fresh] = True
            d = ((self.centroids[fresh] - x[:, None, :]) ** 2).sum(-1)
            d[~first] = np.inf
            all_d, all_ids = np.concatenate([dist, d], 1), np.concatenate([ids, fresh], 1)
            all_done = np.concatenate([done, ~first], 1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist, ids, done = (np.take_along_axis(v, order, 1) for v in (all_d, all_ids, all_done))
            open_ = np.argmin(done, axis=1)
            if done[np.arange(q), open_].all():
                return ids, np.sqrt(dist)
            done[np.arange(q), open_] = True
            fresh = self.near[ids[np.arange(q), open_]]

    def home(self, x: np.ndarray, ratio: float = REPLICA_RATIO, beam: int = 24) -> tuple[np.ndarray, np.ndarray]:
        """``(row, list)`` of the lists that each vector is put on."""
        ids, d = self.search(x, beam)
        row, at = np.nonzero(d[:, :MOST_REPLICAS] <= d[:, :1] * ratio)
        return row, ids[row, at]

    def probes(self, x: np.ndarray, sizes: np.ndarray, ratio: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """``(row, list)`` of the lists that each query reads."""
        ids, d = self.search(x, beam)
        before = np.cumsum(sizes[ids], axis=1) - sizes[ids]
        row, at = np.nonzero((d <= d[:, :1] * ratio) | (before < LEAST_READ))
        return row, ids[row, at]


def fitting_ratio(graph: CentroidGraph, x: np.ndarray, k: int, target: float, replica_ratio: float = REPLICA_RATIO) -> float:
    """The distance ratio at which ``target`` of the sample's true neighbour pairs share a list that is read."""
    asked = x[:256]
    d = _squares(asked, x)
    d[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(d, axis=1, kind="stable")[:, :min(k, len(x) - 1)]
    if not near.size:
        return 1.0
    to = np.sqrt(_squares(asked, graph.centroids))
    to /= np.maximum(to.min(1, keepdims=True), 1e-12)
    row, at = graph.home(x[near.ravel()], replica_ratio)
    needed = np.full(near.size, np.inf)
    np.minimum.at(needed, row, to[row // near.shape[1], at])
    return float(np.quantile(needed, target)) + 0.002


def nearest_in_block(queries: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query, ids, distances)``: the ``k`` smallest by distance, then id, of each query."""
    lead = np.array([i[0] for i in ids], np.int64)
    for a in range(0, len(queries), 256):
        part = queries[a:a + 256]
        d = _squares(part, vectors)
        take = min(k + 8, len(vectors))
        some = np.argpartition(d, take - 1, axis=1)[:, :take]
        edge = np.take_along_axis(d, some, 1).max(1)
        for r in range(len(part)):
            near = some[r]
            if take < len(vectors):  # vectors as far as the last, within rounding: smaller ids go first
                near = np.flatnonzero(d[r] <= edge[r] * (1 + 1e-9))
            exact = np.sqrt(((vectors[near] - part[r]) ** 2).sum(1))
            order = np.lexsort((lead[near], exact))[:k]
            found = [ids[near[o]] for o in order]
            dist = np.repeat(exact[order], [len(f) for f in found])
            flat = np.concatenate(found)
            order = np.lexsort((flat, dist))[:k]
            yield a + r, flat[order], dist[order]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an equal-length list column as float64."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``: rows with an id and a finite vector that is not zero."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))
                   & F.exists(v, lambda x: x != 0)))


def search_vectors(vectors: DataFrame, *, query_step: int = 100, k: int = K, sample_rows: int = SAMPLE_ROWS,
                   list_size: int = LIST_SIZE, most_lists: int = MOST_LISTS, replica_ratio: float = REPLICA_RATIO,
                   target: float = TARGET, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest of each query.

    Queries are the rows whose id is divisible by ``query_step``.
    """
    spark, sc = vectors.sparkSession, vectors.sparkSession.sparkContext
    rows = usable(vectors)
    result = "query_id long, rank int, vec_id long, score double"
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()["v"].combine_chunks()
    sizes = sample.value_lengths().to_numpy()
    if not len(sizes):
        return spark.createDataFrame([], result)
    dim = int(np.bincount(sizes).argmax())
    rows = rows.where(F.size("v") == dim).distinct()

    # equal vectors: the ids that can be in an answer, and the queries
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    groups = stage(ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                   .withColumn("gid", F.col("ids")[0]), "search-vectors")
    asked = rows.where(F.col("vec_id") % query_step == 0).select("vec_id", "v")
    asked = asked.join(groups.select("v", "gid"), "v").select(F.col("vec_id").alias("query_id"), "gid", "v")
    asked = stage(asked, "search-queries")

    total = groups.count()
    x = _matrix(sample.filter(pa.array(sizes == dim)))
    lists = max(1, min(most_lists, total // list_size, len(x) // 4))
    graph = CentroidGraph.build(balanced_centroids(x, lists))
    probe_ratio = fitting_ratio(graph, x, k, target, replica_ratio)
    shared = sc.broadcast(graph)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("v"))
            for a in range(0, len(m), 256):
                row, to = shared.value.home(m[a:a + 256], replica_ratio)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), *(batch.column(c).take(pa.array(a + row)) for c in ("v", "ids", "gid"))],
                    ["list", "v", "ids", "gid"])

    posted = stage(groups.select("v", "ids", "gid").mapInArrow(
        put, "list long, v array<float>, ids array<long>, gid long"), "search-lists")
    held = np.zeros(len(graph.centroids), np.int64)
    for r in posted.groupBy("list").count().collect():  # a row for each list
        held[r["list"]] = r["count"]
    blocks = np.maximum(1, -(-held // block_rows))
    layout = sc.broadcast((held, blocks))
    cuts = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "list long, blocks int")
    members = (posted.join(F.broadcast(cuts), "list")
               .withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")).drop("blocks"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = layout.value
        for batch in batches:
            m = _matrix(batch.column("v"))
            for a in range(0, len(m), 128):
                row, to = shared.value.probes(m[a:a + 128], held, probe_ratio)
                n = blocks[to]
                row, to = np.repeat(row, n), np.repeat(to, n)
                block = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), pa.array(block.astype(np.int32)),
                     *(batch.column(c).take(pa.array(a + row)) for c in ("v", "gid"))], ["list", "block", "q", "qid"])

    probes = (asked.dropDuplicates(["gid"]).select("gid", "v")
              .mapInArrow(ask, "list long, block int, q array<float>, qid long"))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(left) and len(right):
            qid = left["qid"].to_numpy()
            ids = [np.array(i, np.int64) for i in right["ids"].to_pylist()]
            for r, found, dist in nearest_in_block(_matrix(left["q"]), _matrix(right["v"]), ids, k + 1):
                for c, v in zip(out, (np.full(len(found), qid[r]), found, dist)):
                    c.append(v)
        flat = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, float))]
        return pa.table({"qid": flat[0], "vec_id": flat[1], "score": flat[2]})

    found = (probes.groupBy("list", "block").cogroup(members.groupBy("list", "block"))
             .applyInArrow(meet, "qid long, vec_id long, score double"))
    best = found.groupBy("qid", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    best = best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r")
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asked.select("query_id", F.col("gid").alias("qid")).join(best, "qid").where(F.col("vec_id") != F.col("query_id"))
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
