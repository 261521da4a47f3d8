"""N-gram Jaccard join with token-combination prefixes, and the groups that its links make.

A document's tokens are its distinct five-word shingles, as 64-bit hashes. Two
documents link when ``100 * |A and B| >= 75 * |A or B|``. Equal sets are one
class from the start; the rest of the work is on one document of each class.

1. *Who can link at all.* If A links to B, at most ``|A| // 4`` tokens of A
   occur in no other class. Counting this over the tokens in the lowest 2/5 of
   the hash range is enough to exclude most classes exactly. Tokens travel as
   blocks of 32-bit remainders by hash range, those that repeat within a batch
   already added up, so a hot token sends one number per batch.
2. *Prefixes.* Tokens are ordered rare first, then by hash; a token is frequent
   if more than ``FREQUENT`` classes have it (more, where that is needed to
   keep the list of frequent tokens under ``MOST_FREQUENT``, the bound of what
   is broadcast). Linked classes share at least ``K`` tokens among the first
   ``n - ceil(0.75 n) + K`` of each, and one among the first ``... + 1``. So a rare
   token of the prefix is indexed by itself, and frequent ones by combinations
   of ``K``: if no rare token is shared, ``K`` frequent ones are. Frequent tokens
   of a class with more than ``MOST_COMBINED`` of them in its prefix (large
   groups of near copies) are indexed by themselves everywhere, which is the
   exact way for what combinations would blow up.
3. *Verification in rounds.* First each class is paired with one class of each
   of its keys, the one that shares the most keys with others (in a group of
   near copies, that with the fewest edits), so a key's pairs grow with its rows,
   not their square. Verified links make groups. Then, for keys whose classes are
   in several groups, all pairs between groups follow that share a key among the first ``n - o + K`` tokens of both, ``o`` being the overlap that their sizes need.
   Keys of more than ``CROWDED`` classes send bitmaps instead of pairs, by blocks of classes.
   Pairs inside a group can change no result. Before the sets of a pair are
   compared, bitmaps of 4,096 bits bound its overlap, which removes nearly all false ones.

Defined results: null and empty texts, or white space only, have no shingle,
link with nothing and are their own component; a text of fewer than five words
has one shingle. Repeated rows each get a row. A row with a null id links like
others; its component's smallest id is null if all its ids are. The one chance for
error is a 64-bit hash collision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.skew import join_per_key
from starloom.llm.textblock import mix, release_memory, shingle_sets, slices
from starloom.sinks.staging import stage

SHINGLE = 5
K = 2
FREQUENT = 16
MOST_FREQUENT = 1 << 21
MOST_COMBINED = 24
#: Shared keys for which a pair with a hub is looked at; the last round looks at all.
HUB_KEYS = 3
BITMAP_WORDS = 64
#: Classes of a key beyond which its pairs are sought by blocks of ``BLOCK_CLASSES`` classes.
CROWDED = 64
BLOCK_CLASSES = 512
#: Region tokens to a block group, about.
BLOCK_TOKENS = 4_000_000

_U = np.uint64
_REGION = _U((1 << 64) // 5 * 2)


def prefix_length(n: int) -> int:
    """Tokens of a set of ``n`` among which a linked set shares ``K``."""
    return min(n, n // 4 + K)


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: ``(first row, rows, row of token, token, n of row, class id of row)``."""
    for w in slices(column):
        row, h = shingle_sets(w, SHINGLE)
        n = np.bincount(row, minlength=w.rows)
        sid = np.zeros(w.rows, np.int64)
        has = np.flatnonzero(n)
        if len(has):
            start = np.cumsum(n[has]) - n[has]
            total = np.add.reduceat(mix(h ^ _U(0xC0FFEE)), start)
            sid[has] = mix(total + n[has].astype(_U) * _U(0x9E3779B97F4A7C15)).view(np.int64)
        yield w.first_row, w.rows, row, h, n, sid


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, class ``sid`` (null without shingles), ``n`` and ``m``: set size, all and in the region; ``h``: hash of the text."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ns, ms, sids = [], [], []
        for _, rows, row, h, n, sid in _sets(batch.column("text")):
            ns.append(n)
            ms.append(np.bincount(row[h < _REGION], minlength=rows))
            sids.append(sid)
        n = np.concatenate(ns) if ns else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array(np.concatenate(sids) if sids else n, pa.int64(), mask=n == 0),
            pa.array(n, pa.int64()), pa.array(np.concatenate(ms) if ms else n, pa.int64()), batch.column("h")],
            ["doc_id", "sid", "n", "m", "h"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")).mapInArrow(
        _each(run), "doc_id long, sid long, n long, m long, h long")


def _each(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs ``work`` on batch after batch and gives back what each one held before the next is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)
            release_memory()

    return run


_BLOCK = "bucket int, kind int, sids binary, runs binary, tokens binary"


def _region_blocks(docs: DataFrame, bits: int) -> DataFrame:
    """Region tokens of each batch's distinct classes, by the top ``bits`` of the hash.

    Kind 0: tokens one class of the batch has, as runs by class. Kind 1: tokens
    of several, with their counts. Kind 2: how many such tokens a class has.
    """
    low = _U(32 - bits)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens, owners, seen = [], [], np.zeros(0, np.int64)
        for _, rows, row, h, n, sid in _sets(batch.column("text")):
            fresh = np.zeros(rows, bool)
            fresh[np.unique(sid, return_index=True)[1]] = True
            fresh &= (n > 0) & ~np.isin(sid, seen)
            seen = np.concatenate([seen, sid[fresh]])
            keep = fresh[row] & (h < _REGION)
            tokens.append(h[keep] >> low)
            owners.append(sid[row[keep]])
        key = np.concatenate(tokens) if tokens else np.zeros(0, _U)
        sid = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        if not len(key):
            return
        out: list[tuple] = []
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(ordered)))
        several = np.zeros(len(key), bool)
        several[order] = np.repeat(size > 1, size)
        again, count = ordered[first][size > 1], size[size > 1]
        bucket = (again >> _U(32)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            here = bucket == b
            out.append((b, 1, b"", count[here].astype("<u4").tobytes(), again[here].astype("<u4").tobytes()))
        if several.any():
            ids, count = np.unique(sid[several], return_counts=True)
            out.append((int(key[0] >> _U(32)), 2, ids.tobytes(), count.astype("<u4").tobytes(), b""))
        key, sid = key[~several], sid[~several]
        bucket = (key >> _U(32)).astype(np.uint32 if bits > 16 else np.uint16)
        order = np.argsort(bucket, kind="stable")
        key, sid, bucket = key[order], sid[order], bucket[order]
        cut = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (sid[1:] != sid[:-1])])) if len(key) else np.zeros(0, int)
        runs, run_bucket = np.diff(np.append(cut, len(key))), bucket[cut]
        for b in np.unique(run_bucket).tolist():
            i, j = np.searchsorted(run_bucket, [b, b + 1])
            a, z = cut[i], (cut[j] if j < len(cut) else len(key))
            out.append((b, 0, sid[cut[i:j]].tobytes(), runs[i:j].astype("<u4").tobytes(), key[a:z].astype("<u4").tobytes()))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[2:])],
            ["bucket", "kind", "sids", "runs", "tokens"])

    return docs.select("text").mapInArrow(_each(run), _BLOCK)


def _shared_counts(blocks: DataFrame, frequent: int) -> DataFrame:
    """Rows of kind 0: class ``id`` has ``n`` region tokens that other classes have too; kind 1: frequent key ``id``."""
    def run(group: pa.Table) -> pa.Table:
        tokens, owners, more, counts, ids, n = [], [], [], [], [], []
        bucket = None
        for b, kind, sids, runs, keys in zip(*(group.column(c).to_pylist() for c in ("bucket", "kind", "sids", "runs", "tokens"))):
            bucket, runs = b, np.frombuffer(runs, "<u4")
            if kind == 0:
                tokens.append(np.frombuffer(keys, "<u4"))
                owners.append(np.repeat(np.frombuffer(sids, np.int64), runs))
            elif kind == 1:
                more.append(np.frombuffer(keys, "<u4"))
                counts.append(runs)
            else:
                ids.append(np.frombuffer(sids, np.int64))
                n.append(runs.astype(np.int64))
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
        sid = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(token, kind="stable")
        token, sid = token[order], sid[order]
        extra = np.concatenate(more) if more else np.zeros(0, np.uint32)
        known, back = np.unique(extra, return_inverse=True)
        sums = np.bincount(back, np.concatenate(counts) if counts else None, minlength=len(known)).astype(np.int64)
        # tokens met more than once: one row of each class
        same = token[1:] == token[:-1]
        twice = np.zeros(len(token), bool)
        twice[1:] |= same
        twice[:-1] |= same
        if len(known):
            twice |= known[np.minimum(np.searchsorted(known, token), len(known) - 1)] == token
        token, sid = token[twice], sid[twice]
        order = np.lexsort((sid, token))
        token, sid = token[order], sid[order]
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        token, sid = token[keep], sid[keep]
        value, where, size = np.unique(token, return_inverse=True, return_counts=True)
        if len(known) and len(value):
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            size = size + np.where(known[at] == value, sums[at], 0)
        own, count = np.unique(sid[size[where] > 1], return_counts=True)
        ids.append(own)
        n.append(count.astype(np.int64))
        alone = ~np.isin(known, value)
        hot = np.concatenate([value[size > frequent], known[alone & (sums > frequent)]]).astype(_U)
        hot = ((_U(bucket) << _U(32)) | hot).view(np.int64) if len(hot) else np.zeros(0, np.int64)
        sid, n = np.concatenate(ids), np.concatenate(n)
        return pa.Table.from_arrays([
            pa.array(np.concatenate([np.zeros(len(sid), np.int32), np.ones(len(hot), np.int32)])),
            pa.array(np.concatenate([sid, hot])), pa.array(np.concatenate([n, np.zeros(len(hot), np.int64)]))],
            ["kind", "id", "n"])

    return blocks.groupBy("bucket").applyInArrow(run, "kind int, id long, n long")


def _token_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``sid``, ``n``, ordered ``tokens`` and ``bits`` of the chosen classes, from the text of one document of each."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        wanted = batch.column("sid").to_numpy(zero_copy_only=False)
        for first, rows, row, h, n, sid in _sets(batch.column("text")):
            good = (n > 0) & (sid == wanted[first:first + rows])
            h = h[good[row]]
            n, sid = n[good], sid[good]
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
            marked = np.zeros((len(n), BITMAP_WORDS * 64), np.uint8)
            marked[np.repeat(np.arange(len(n)), n), (h % _U(BITMAP_WORDS * 64)).astype(np.int64)] = 1
            bits = np.packbits(marked, axis=1, bitorder="little").view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([
                pa.array(sid), pa.array(n.astype(np.int64)),
                pa.LargeListArray.from_arrays(ends, pa.array(h.view(np.int64))).cast(pa.list_(pa.int64())),
                pa.FixedSizeListArray.from_arrays(pa.array(bits), BITMAP_WORDS).cast(pa.list_(pa.int64()))],
                ["sid", "n", "tokens", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by_id = rows.join(chosen.select("doc_id", "sid").hint("shuffle_hash"), "doc_id").select("text", "sid")
    # classes whose rows all lack an id: by the hash of a text, of which one row is taken
    no_id = chosen.where(F.col("doc_id").isNull()).select("h", "sid")
    by_text = (rows.where(F.col("doc_id").isNull()).select("text", F.xxhash64("text").alias("h"))
               .join(no_id, "h").dropDuplicates(["sid"]).select("text", "sid"))
    return by_id.unionByName(by_text).mapInArrow(_each(run), "sid long, n long, tokens array<long>, bits array<long>")


def _among(key: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(key), bool)
    return ordered[np.minimum(np.searchsorted(ordered, key), len(ordered) - 1)] == key


def _prefixes(batch: pa.RecordBatch, low: np.uint64, frequent: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(sid, n, rare tokens, frequent tokens)`` of the prefix of each set."""
    lists = batch.column("tokens")
    bounds = lists.offsets.to_numpy()
    values = lists.values.to_numpy().view(_U)
    hot = (values < _REGION) & _among(values >> low, frequent)
    for k, (sid, n) in enumerate(zip(batch.column("sid").to_pylist(), batch.column("n").to_pylist())):
        a, b = bounds[k], bounds[k + 1]
        size = prefix_length(n)
        token, is_hot = values[a:b], hot[a:b]
        rare = token[~is_hot][:size]
        yield sid, n, rare, token[is_hot][:size - len(rare)]


def _wide(sets: DataFrame, bits: int, frequent, most: int) -> DataFrame:
    """Keys of frequent tokens in prefixes with more than ``most`` of them."""
    low = _U(32 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hot >> low for _, _, _, hot in _prefixes(batch, low, frequent.value) if len(hot) > most]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], ["key"])

    return sets.select("sid", "n", "tokens").mapInArrow(run, "key long").distinct()


def _postings(sets: DataFrame, bits: int, frequent, wide) -> DataFrame:
    """Index rows: ``key``, ``place`` of its (last) token in the set's order, ``sid`` and ``n``."""
    low = _U(32 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, owner, sizes = [], [], [], []

            def put(key, place, sid, n):
                keys.append(key)
                places.append(place.astype(np.int32))
                owner.append(np.full(len(key), sid, np.int64))
                sizes.append(np.full(len(key), n, np.int64))

            for sid, n, rare, hot in _prefixes(batch, low, frequent.value):
                alone = _among(hot >> low, wide.value)
                place = len(rare) + np.arange(len(hot))
                put(np.concatenate([rare, hot[alone]]), np.concatenate([np.arange(len(rare)), place[alone]]), sid, n)
                hot, place = hot[~alone], place[~alone]
                if len(hot) > 1:
                    i, j = np.triu_indices(len(hot), 1)
                    put(mix(hot[i] * _U(3) + hot[j]), place[j], sid, n)
            if keys:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(places)),
                    pa.array(np.concatenate(owner)), pa.array(np.concatenate(sizes))], ["key", "place", "sid", "n"])

    return sets.select("sid", "n", "tokens").mapInArrow(run, "key long, place int, sid long, n long")


def _fits(na: Column, nb: Column, overlap: Column) -> Column:
    """Whether an overlap is enough: ``overlap >= 0.75 * union`` is ``7 * overlap >= 3 * (na + nb)``."""
    return 7 * overlap >= 3 * (na + nb)


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of distinct ``(a, b)``, those that link.

    Each bit of a class's bitmap that another's lacks stands for a token that
    the other lacks, which bounds the overlap; the sets of the rest are compared.
    """
    def side(name, more):
        return sets.select(F.col("sid").alias(name), F.col("n").alias(f"n{name}"), F.col(more).alias(f"{more}_{name}"))

    def lacks(x, y):
        bits = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(bits, F.lit(0), lambda t, n: t + n)

    na, nb, x, y = (F.col(c) for c in ("na", "nb", "bits_a", "bits_b"))
    likely = (pairs.select("a", "b").join(side("a", "bits"), "a").join(side("b", "bits"), "b")
              .where((4 * F.least(na, nb) >= 3 * F.greatest(na, nb))
                     & _fits(na, nb, na - lacks(x, y)) & _fits(na, nb, nb - lacks(y, x))).select("a", "b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return (likely.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b")
            .where(_fits(na, nb, both)).select("a", "b").distinct())


def _open_keys(postings: DataFrame, grouped: DataFrame) -> DataFrame:
    """Index rows of the keys whose classes are in several groups, with the class's group and the key's ``largest``."""
    entry = (postings.join(grouped.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("component", F.coalesce("component", "sid")))
    largest = (entry.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"))
               .groupBy("key").agg(F.max_by("component", "rows").alias("largest"), F.count(F.lit(1)).alias("groups"))
               .where("groups > 1").drop("groups"))
    return stage(entry.join(largest, "key"), "near-open")


def _pairs_by_key(entry: DataFrame) -> DataFrame:
    """Pairs of different groups that share a key among the first ``n - o + K`` tokens of both."""
    a = entry.where("component != largest").select("key", F.col("place").alias("pa"), F.col("sid").alias("a"),
                                                   F.col("n").alias("na"), F.col("component").alias("ca"))
    b = entry.select(F.col("key").alias("kb"), F.col("place").alias("pb"), F.col("sid").alias("b"), F.col("n").alias("nb"),
                     F.col("component").alias("cb"), "largest")
    na, nb = F.col("na"), F.col("nb")
    return (a.join(b, (F.col("key") == F.col("kb")) & (F.col("ca") != F.col("cb"))
                   & ((F.col("cb") == F.col("largest")) | (F.col("a") < F.col("b")))
                   & (4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb"))
                   & _fits(na, nb, na - F.col("pa") + K - 1) & _fits(na, nb, nb - F.col("pb") + K - 1))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _pairs_by_block(entry: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different groups among the classes of crowded keys, where the bitmaps let them link.

    Keys with the same largest group are one family: its classes are cut into
    blocks of ``BLOCK_CLASSES``, and each two blocks meet in a task of their own,
    however many keys their classes share. Only what the bitmaps pass is given out.
    """
    family = entry.select(F.col("largest").alias("family"), "sid", "component").distinct()
    blocks = family.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).cast("int").alias("blocks"))
    family = (family.join(blocks, "family").join(sets.select("sid", "n", "bits"), "sid")
              .withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))
    columns = ("family", "sid", "n", "component", "bits")
    left, right = (rows.select(*(F.col(c).alias(c) for c in columns), F.col("own").alias(own), F.col("other").alias(other))
                   for rows, own, other in ((family.where("component != family"), "i", "j"), (family, "j", "i")))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        def read(t):
            return (*(t[c].to_numpy() for c in ("sid", "n", "component")),
                    np.stack(t["bits"].to_numpy()).view(_U) if len(t) else np.zeros((0, BITMAP_WORDS), _U))

        (a, na, ca, x), (b, nb, cb, y) = read(left), read(right)
        out = [(np.zeros(0, np.int64),) * 2]
        for k in range(0, len(a) if len(b) else 0, 16):
            part = slice(k, k + 16)
            shared = np.bitwise_count(x[part, None] & y[None]).sum(2, dtype=np.int64)
            most = np.minimum(na[part, None] - np.bitwise_count(x[part]).sum(1, dtype=np.int64)[:, None],
                              (nb - np.bitwise_count(y).sum(1, dtype=np.int64))[None]) + shared
            total = na[part, None] + nb[None]
            good = (7 * most >= 3 * total) & (ca[part, None] != cb[None])
            good &= (cb == right["family"][0].as_py())[None] | (a[part, None] < b[None])
            i, j = np.nonzero(good)
            out.append((a[part][i], b[j]))
        a, b = (np.concatenate(c) for c in zip(*out))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    keys = ("family", "i", "j")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "a long, b long")


def _merged(links: DataFrame, grouped: DataFrame | None) -> DataFrame:
    """Groups of the links and of the groups so far."""
    if grouped is not None:
        links = links.union(grouped.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return stage(components(links), "near-groups")


def linked_classes(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """``(node, component)`` of the classes that link with another class."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    classes = (signed.where(F.col("sid").isNotNull()).groupBy("sid")
               .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("m").alias("m"), F.min("h").alias("h")))
    total = signed.agg(F.sum("m").alias("m")).first()["m"] or 0
    bits = min(24, max(3, int(np.ceil(np.log2(max(total / 0.4 / BLOCK_TOKENS, 1))))))
    limit = max(FREQUENT, -(-total // MOST_FREQUENT))

    shared = stage(_shared_counts(_region_blocks(docs, bits), limit), "near-shared")
    frequent = np.sort(shared.where("kind = 1").select("id").distinct().toArrow()["id"].to_numpy().view(_U))
    counts = shared.where("kind = 0").groupBy(F.col("id").alias("sid")).agg(F.sum("n").alias("shared"))
    chosen = (classes.join(counts, "sid", "left")
              .where(F.col("m") - F.coalesce("shared", F.lit(0)) <= F.floor(F.col("n") / 4)))
    sets = stage(_token_sets(docs, chosen), "near-sets")

    frequent = sc.broadcast(frequent)
    wide = sc.broadcast(np.sort(_wide(sets, bits, frequent, MOST_COMBINED).toArrow()["key"].to_numpy().view(_U)))
    postings = _postings(sets, bits, frequent, wide)
    # a key of one class links nothing
    several = (postings.groupBy("key").agg(F.min("sid").alias("first"), F.max("sid").alias("last"), F.count(F.lit(1)).alias("rows"))
               .where("first != last").select("key", "rows"))
    postings = stage(postings.join(several, "key"), "near-postings")

    # each class with the one that shares the most with others, of each of its keys
    central = postings.groupBy("sid").agg(F.sum("rows").alias("weight"))
    hub = postings.select("key", "sid").join(central, "sid").groupBy("key").agg(F.max_by("sid", "weight").alias("hub"))
    pairs = (postings.select("key", "sid").join(hub, "key").where("sid != hub")
             .groupBy(F.col("sid").alias("a"), F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("keys")))
    grouped = _merged(stage(_links(pairs.where(F.col("keys") >= HUB_KEYS), sets), "near-links"), None)

    # all pairs of different groups: by key, and by blocks of classes for the keys of many classes
    entry = _open_keys(postings, grouped)
    rest = _pairs_by_key(entry.where(F.col("rows") <= CROWDED)).union(
        _pairs_by_block(entry.where(F.col("rows") > CROWDED), sets))
    late = stage(_links(rest.distinct(), sets), "near-late-links")
    return _merged(late, grouped) if late.take(1) else grouped


def _assigned(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id``, ``n``, ``sid``, ``h``, its ``component`` (null without shingles) and that one's smallest id."""
    signed = stage(signatures(docs), "near-signatures")
    grouped = linked_classes(docs, signed)
    classes = signed.where(F.col("sid").isNotNull()).groupBy("sid").agg(F.min("doc_id").alias("own"))
    classes = classes.join(grouped.withColumnRenamed("node", "sid"), "sid", "left")
    classes = stage(classes.select("sid", "own", F.coalesce("component", "sid").alias("component")), "near-classes")
    least = classes.groupBy("component").agg(F.min("own").alias("component_id"))
    per_sid = stage(join_per_key(classes, least, "component").select("sid", "component", "component_id"), "near-components")
    return join_per_key(signed, per_sid, "sid")


def near_copy_components(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links)."""
    return _assigned(docs).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents without the near copies of others: of each group the one with the smallest id stays.

    Rows that repeat an id and a text are one document. Of a group whose rows all lack an id one text stays, and one row of it; rows
    without an id in other groups go. A document without words is in no group: each id stays once with its text, and every row without an id.
    """
    rows = stage(_assigned(docs), "near-assigned")
    own = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = rows.where(F.col("doc_id") == own).select("doc_id").distinct()
    known = docs.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    nameless = docs.where(F.col("doc_id").isNull())
    wordless = F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    chosen = rows.where(F.col("sid").isNotNull() & F.col("component_id").isNull()).groupBy("component").agg(F.min("h").alias("_h"))
    one_text = (nameless.where(~wordless).withColumn("_h", F.xxhash64("text")).join(chosen.select("_h"), "_h", "left_semi")
                .dropDuplicates(["_h"]))
    out = known.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return out.unionByName(one_text.select(*docs.columns)).unionByName(nameless.where(wordless))
