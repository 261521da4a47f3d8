"""SimHash near-duplicates by pigeonring filtering (operator 13).

A text's fingerprint has a bit set if more than half of the hashes of its word
shingles have it set. Two fingerprints link if at most ``tau`` of 64 bits differ.

The 64 bits are cut into ``SEGMENTS`` consecutive segments on a ring. If two
fingerprints differ in at most ``tau`` bits, there is a segment from which every chain
of ``l`` consecutive segments, for all ``l`` at once, differs in at most ``l * tau /
SEGMENTS`` bits (the pigeonring principle: were there none, the ring's total would exceed ``tau``). While that
budget is below one, the segments are equal, so the longest such chain (two of five
segments: 26 bits) is a key under which candidates meet; the budgets of the longer chains
then prune them, before the full Hamming check. A key under which more than ``CELL``
fingerprints lie is drawn out by the next segment: its budget allows one bit there, so a
fingerprint goes to the key of that whole segment and to one key for each bit left out.
What is still larger is dealt into blocks of ``CELL``, and each pair of blocks is a cell.

Equal fingerprints are one node, whatever the number of documents. ``near_pairs`` gives
every link; for components a cell may instead give a spanning forest of its links,
which joins the same fingerprints. Candidates are worked in slabs of bounded size.

Rows: a null or empty text, or one without words, has fingerprint zero, which is linked like any
other; fewer words than a shingle are one shingle. Texts are read in pieces, so a very
long one costs its own bytes. Repeated rows and rows with a null id are documents like others; the
component of documents that all lack an id is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.skew import join_per_key, whole_groups
from starloom.sinks.staging import stage

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
TAU = 2
SEGMENTS = 5

#: Fingerprints of a cell's side; candidate pairs held at once; rows of the stream worked at once.
CELL = 4096
SLAB = 1 << 20
STREAM_ROWS = 1 << 16
PIECE_BYTES = 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, by pieces that end at a word's end."""
    if len(text) <= PIECE_BYTES:
        yield text.lower().split()
        return
    at = 0
    while at < len(text):
        end = at + PIECE_BYTES
        if end < len(text):
            ends = [k for k in (text.find(bytes([c]), end) for c in _SPACE) if k >= 0]
            end = min(ends, default=len(text))
        yield text[at:end].lower().split()
        at = end


def fingerprint(text: bytes, *, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text's UTF-8 bytes (unsigned); zero where it has no words."""
    ones, total, last, short = np.zeros(BITS, np.int64), 0, [], []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for words in _pieces(text):
        words = last + words
        if len(words) >= size:
            grams = zip(*(words[k:] for k in range(size)))
            h = np.array([digest(join(g), seed) for g in grams], np.uint64)
            for a in range(0, len(h), 1 << 14):
                ones += np.unpackbits(h[a:a + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                      bitorder="little").sum(0, dtype=np.int64)
            total += len(h)
            last = words[len(words) - size + 1:]
        else:
            last = words
    if not total:
        if not last:
            return 0
        return digest(join(last), seed)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of every document; ``fp`` holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            out = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


class Ring:
    """Segments of the bits and the budgets of chains of them."""

    def __init__(self, tau: int, segments: int):
        if not 0 <= tau < segments <= 32:
            raise ValueError("there must be more segments than differing bits, 32 at most")
        cut = np.linspace(0, BITS, segments + 1).astype(int)
        self.tau, self.m = tau, segments
        self.start, self.width = cut[:-1].tolist(), np.diff(cut).tolist()
        self.budget = [length * tau // segments for length in range(segments + 1)]
        self.exact = max(length for length in range(1, segments + 1) if self.budget[length] == 0)
        # a longer chain, whose last segment may differ in one bit, if the ring has it
        self.drawn = self.exact + 1 <= segments and self.budget[self.exact + 1] == 1

    def mask(self, segment: int) -> int:
        return ((1 << self.width[segment]) - 1) << self.start[segment]

    def chain_mask(self, first: int, length: int) -> int:
        return sum(self.mask((first + k) % self.m) for k in range(length))

    def viable(self, x: np.ndarray, first: int) -> np.ndarray:
        """Where all chains from ``first`` keep their budgets, of differences ``x``; the last chain is all 64 bits."""
        ok = np.flatnonzero((x & np.uint64(self.chain_mask(first, self.exact))) == 0)
        for length in range(self.exact + 1, self.m + 1):
            part = np.bitwise_count(x[ok] & np.uint64(self.chain_mask(first, length)))
            ok = ok[part <= self.budget[length]]
        return ok


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _masked(fp: Column, mask: int) -> Column:
    return fp.bitwiseAND(F.lit(_signed(mask)))


def _cells(nodes: DataFrame, ring: Ring) -> DataFrame:
    """``(cell, first, bit, side, fp)``: the fingerprints under the keys of their chains."""
    fp = F.col("fp")
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("first"), F.lit(-1).alias("bit"), F.xxhash64(F.lit(i), _masked(fp, ring.chain_mask(i, ring.exact))).alias("key"))
        for i in range(ring.m)])).alias("k")).select("fp", "k.*")

    def sized(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL)

    large = sized(keyed)
    if ring.drawn:
        few = keyed.join(large, "key", "left_anti")
        variants = []
        for i in range(ring.m):
            last = (i + ring.exact) % ring.m
            whole = ring.chain_mask(i, ring.exact + 1)
            bits = [ring.start[last] + k for k in range(ring.width[last])]
            variants.append(F.array(*[F.struct(F.lit(b).alias("bit"), F.xxhash64(F.lit(i), F.lit(b), _masked(fp, whole & ~(0 if b < 0 else 1 << b))).alias("key"))
                                      for b in [-2, *bits]]))
        chosen = F.element_at(F.array(*variants), F.col("first") + 1)
        many = (keyed.join(large.select("key"), "key", "left_semi").select("fp", "first", F.explode(chosen).alias("v"))
                .select("fp", "first", "v.*"))
        keyed = few.select("fp", "first", "bit", "key").unionByName(many)
        large = sized(many)
    dealt = keyed.join(large, "key", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("size") / CELL), F.lit(1)).cast("int"))
    dealt = (dealt.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(F.xxhash64("key", i, j).alias("cell"), "first", "bit",
                        F.when(i == j, 0).when(F.col("own") == i, 1).otherwise(2).alias("side"), "fp")


def _candidates(size: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``i < j`` within groups of consecutive rows, in slabs of about ``SLAB`` pairs."""
    rows = np.arange(size.sum())
    ends = np.repeat(start + size, size)
    partners = ends - rows - 1
    done = np.concatenate([[0], np.cumsum(partners)])
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(done, done[at] + SLAB, "right")) - 1)
        n = partners[at:stop]
        i = np.repeat(rows[at:stop], n)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(done[at:stop] - done[at], n)
        at = stop


def _forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as ``(i, j)`` do: each node with the smallest one it reaches."""
    nodes, ends = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = ends[:len(i)], ends[len(i):]
    least = np.arange(len(nodes))
    while True:
        now = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(now, a, low)
        np.minimum.at(now, b, low)
        np.minimum.at(now, least[a], low)
        np.minimum.at(now, least[b], low)
        now = now[now]
        if (now == least).all():
            break
        least = now
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[other]], nodes[other]


def near_pairs(nodes: DataFrame, *, tau: int = TAU, segments: int = SEGMENTS, spanning: bool = False) -> DataFrame:
    """``(a, b, distance)``: each two distinct fingerprints ``fp`` that differ in at most ``tau`` bits.

    With ``spanning`` each cell gives edges that join the fingerprints it links, without
    a ``distance``, instead of all its links. ``nodes`` must be distinct.
    """
    ring = Ring(tau, segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", STREAM_ROWS):
            cell, first, bit, side = (table.column(c).to_numpy() for c in ("cell", "first", "bit", "side"))
            fp = table.column("fp").to_numpy().view(np.uint64)
            start = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
            size = np.diff(np.concatenate([start, [len(cell)]]))
            found = []
            for i, j in _candidates(size, start):
                meet = ((side[i] != side[j]) | (side[i] == 0)) & (first[i] == first[j]) & (bit[i] == bit[j])
                i, j = i[meet], j[meet]
                x = fp[i] ^ fp[j]
                for chain in range(ring.m):
                    of_chain = np.flatnonzero(first[i] == chain)
                    ok = of_chain[ring.viable(x[of_chain], chain)]
                    ok = ok[(x[ok] != 0) & _drawn_once(x[ok], bit[i[ok]], ring, chain)]
                    if not spanning:  # a pair with several such chains comes from the first
                        for earlier in range(chain):
                            again = ring.viable(x[ok], earlier)
                            ok = np.delete(ok, again)
                    if len(ok):
                        found.append((i[ok], j[ok]))
            if not found:
                continue
            i, j = (np.concatenate(c) for c in zip(*found))
            distance = None
            if spanning:
                # the forest runs over fingerprints, which several cells of the table may hold
                known, place = np.unique(fp, return_inverse=True)
                i, j = _forest(place[i], place[j])
                a, b = known[i], known[j]
            else:
                a, b = fp[i], fp[j]
                distance = np.bitwise_count(a ^ b).astype(np.int32)
            a, b = a.view(np.int64), b.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                 pa.nulls(len(a), pa.int32()) if distance is None else pa.array(distance)], ["a", "b", "distance"])

    return (_cells(nodes.select("fp"), ring).repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(run, "a long, b long, distance int"))


def _drawn_once(x: np.ndarray, bit: np.ndarray, ring: Ring, chain: int) -> np.ndarray:
    """Pairs that meet by right: under a key that leaves out a bit, those that differ in that bit; under the whole segment's, those equal there."""
    last = ring.mask((chain + ring.exact) % ring.m)
    there = np.where(bit < 0, 0, np.left_shift(np.uint64(1), np.maximum(bit, 0).astype(np.uint64)))
    return (bit == -1) | ((x & np.uint64(last)) == there)


def simhash_components(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable by links)."""
    signed = stage(fingerprints(docs), "simhash")
    nodes = stage(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    groups = components(near_pairs(nodes, spanning=True), "simhash-links")
    linked = stage(groups.withColumnRenamed("node", "fp").join(nodes, "fp"), "simhash-groups")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = join_per_key(linked, least, "component").select("fp", "component_id", F.lit(True).alias("is_linked"))
    per_fp = stage(nodes.join(linked, "fp", "left").select(
        "fp", F.when(F.col("is_linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")), "simhash-least")
    return join_per_key(signed, per_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
