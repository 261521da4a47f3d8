"""Vector codes, spelling variants and SimHash against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import SF, documents, empty, needs_tables, odd, words
from pyspark.sql import functions as F

from starloom.llm import simhash, spelling, vector_codes
from starloom.llm.skew import join_per_key, whole_groups

VECTORS = "vec_id long, embedding array<double>, label int"


# vector codes

def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """``({row number: (code, error)}, digest)`` in Python integers; ``rows`` are ``(vec_id, vector, label)``."""
    kept = [(i, [math.floor(int(x * scale) if float(x).is_integer() else x * scale) if abs(x) < 1e300 else int(x) * scale for x in v])
            for i, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, hashlib.sha256(b"").hexdigest()
    width = len(kept[0][1]) // parts
    order = sorted(kept, key=lambda r: (rows[r[0]][0] is None, rows[r[0]][0] or 0, r[1]))
    books = [[v[p * width:(p + 1) * width] for _, v in order[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v in kept:
                part = v[p * width:(p + 1) * width]
                members[nearest(part, books[p])[1]].append(part)
            for k, of in members.items():
                books[p][k] = [sum(c) // len(of) for c in zip(*of)]
    out = {}
    for i, v in kept:
        found = [nearest(v[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check_codes(spark, rows, **sizes):
    want, digest = plain_codes(rows)
    labels = Counter()
    for i, (_, error) in want.items():
        labels[rows[i][2]] += error
    got = vector_codes.compressed_codes(spark.createDataFrame(rows, VECTORS)).collect()
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == Counter(
        (rows[i][0], code, error, labels[rows[i][2]]) for i, (code, error) in want.items())
    assert {r["codebooks_sha256"] for r in got} <= {digest}


def test_codes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), int(i) % 3 or None) for i in rng.permutation(420)]
    rows += [(500, None, 1), (501, [0.0] * 7 + [None], 1), (502, [0.0] * 7 + [float("nan")], 1), (503, [0.0] * 7 + [float("-inf")], 1)]
    rows += [rows[0], rows[0], (None, [0.5] * 8, 2)]
    check_codes(spark, rows)


def test_codes_of_few_vectors_ties_and_large_components(spark):
    check_codes(spark, [(k, [float(k % 3)] * 4, None) for k in range(9)])
    check_codes(spark, [(1, [-0.0001, 0.0001, 1.0, -1.0], 1), (2, [0.0] * 4, 2)])
    huge = [(1, [3e9, -3e9, 1.5, 0.25], 1), (2, [-3e9, 3e9, 0.0, 0.0], 1), (3, [2e9, 1.0, 0.0, 7.0], 2)]
    check_codes(spark, huge * 90)
    got = vector_codes.compressed_codes(spark.createDataFrame([(k, [1e300 * (k % 300), 0.0, 0.0, 1.0], 1) for k in range(400)], VECTORS)).collect()
    assert len(got) == 400 and all(0 <= r["error"] <= (1 << 63) - 1 for r in got)


def test_codes_of_odd_tables(spark):
    frame = vector_codes.compressed_codes(spark.createDataFrame([], VECTORS))
    assert frame.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and frame.count() == 0
    ragged = [(k, [float(k)] * 5, 1) for k in range(4)] + [(9, [1.0], 1), (10, [], 1)]
    got = {r["vec_id"]: r for r in vector_codes.compressed_codes(spark.createDataFrame(ragged, VECTORS).withColumn("codes", F.lit(1))).collect()}
    assert got[2]["code"] == "02020202" and got[2]["error"] == 0
    assert got[9]["code"] is None and got[10]["error"] is None and got[9]["label_error"] == 0


# spelling

def plain_variants(rows, least=3):
    """``{word: (form, root, n, n_near, form_n)}`` over all pairs."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return plain_forms({w: c for w, c in n.items() if len(w) >= 5 and c >= least})


def plain_forms(n):
    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) > 1 or a == b:
            return False
        k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a[k + (len(a) == len(b)):] == b[k + 1:]

    form, count = {}, {}
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    for w in n:
        close = [v for d in (-1, 0, 1) for v in by_length[len(w) + d] if near(w, v)]
        count[w] = len(close)
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], count[w], n.get(form[w])) for w in n}


def variants(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@needs_tables
def test_spelling_of_documents(spark):
    docs = documents(spark).where("doc_id < 80")
    got = variants(spelling.spelling_of_documents(docs))
    assert got == plain_variants([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(v[0] is not None for v in got.values()) > 20


@pytest.mark.parametrize(("cell", "tile", "stream"), [(4096, 128, 1 << 16), (5, 7, 50), (1, 1, 1)])
def test_spelling_with_cells_and_tiles_of_any_size(spark, monkeypatch, cell, tile, stream):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "STREAM_ROWS", stream)
    rng = random.Random(cell)
    known = {}
    for _ in range(40):
        base = "".join(rng.choice("abé") for _ in range(rng.randrange(4, 9)))
        for _ in range(6):
            k = rng.randrange(max(1, len(base)))
            base = rng.choice([base[:k] + base[k + 1:], base[:k] + rng.choice("abx") + base[k:], base[:k] + "z" + base[k + 1:]])
            if base:
                known[base] = rng.randrange(1, 200)
    known |= {"long" * 30: 5, "long" * 30 + "x": 10, "long" * 15 + "y" + "long" * 15: 30, "a\U0001F600cde": 3, "a\U0001F600cdef": 9}
    frame = spark.createDataFrame(list(known.items()), "word string, n long")
    assert variants(spelling.spelling_variants(frame)) == plain_forms(known)


def test_spelling_chain_is_followed_to_its_end(spark):
    chain = ["a" * k + "bcdef" for k in range(9)]
    known = {w: 3 * 2 ** k for k, w in enumerate(chain)}
    got = variants(spelling.spelling_variants(spark.createDataFrame(list(known.items()), "word string, n long")))
    assert {v[1] for v in got.values()} == {chain[-1]} and got[chain[0]][0] == chain[1]


def test_spelling_of_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    assert variants(spelling.spelling_of_documents(odd(spark))) == plain_variants(rows)
    assert spelling.spelling_of_documents(empty(spark)).count() == 0


# simhash

def plain_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps, tau=2):
    """``{row number: smallest row number it reaches}`` over all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= tau:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in range(len(fps))}


@needs_tables
def test_simhash_of_documents(spark):
    rows = documents(spark).orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    group = plain_groups(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(documents(spark)).collect()}
    assert got == {r["doc_id"]: (f"{fps[k]:016x}", rows[group[k]]["doc_id"]) for k, r in enumerate(rows)}
    assert len(set(group.values())) < len(rows)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(("tau", "segments", "cell", "slab"), [(2, 5, 4096, 1 << 20), (2, 5, 3, 10), (2, 3, 2, 7), (3, 7, 4, 50), (1, 4, 3, 5), (0, 2, 2, 5)])
def test_near_pairs_are_all_found_once(spark, monkeypatch, tau, segments, cell, slab):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "SLAB", slab)
    monkeypatch.setattr(simhash, "STREAM_ROWS", 64)
    rng = random.Random(segments)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(12):
            fps.add(base)
            for _ in range(rng.randrange(1, 4)):
                base ^= 1 << rng.choice([rng.randrange(64), rng.randrange(52, 64)])
    fps = sorted(fps)
    want = {frozenset((signed(a), signed(b))): (a ^ b).bit_count() for k, a in enumerate(fps) for b in fps[:k] if (a ^ b).bit_count() <= tau}
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = simhash.near_pairs(nodes, tau=tau, segments=segments).collect()
    assert len(got) == len(want) and {frozenset((r["a"], r["b"])): r["distance"] for r in got} == want
    if not want:
        return
    joined = simhash.components(simhash.near_pairs(nodes, tau=tau, segments=segments, spanning=True)).collect()
    assert {r["node"]: r["component"] for r in joined} == {
        r["node"]: r["component"] for r in simhash.components(simhash.near_pairs(nodes, tau=tau, segments=segments)).collect()}


def test_pigeonring_budgets():
    ring = simhash.Ring(2, 5)
    assert ring.budget == [0, 0, 0, 1, 1, 2] and ring.exact == 2 and ring.drawn
    assert sum(ring.width) == 64 and ring.chain_mask(4, 2) == ring.mask(4) | ring.mask(0)
    with pytest.raises(ValueError):
        simhash.Ring(5, 5)


def test_fingerprints_of_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["Uno", "dos\t", "trés\n", "x" * 40]) for _ in range(500))
    want = plain_fingerprint(text)
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        assert simhash.fingerprint(text.encode()) == want


def test_simhash_of_odd_rows(spark):
    got = simhash.simhash_components(odd(spark)).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got}
    assert by_id[3] == by_id[4] == by_id[5] == ("0" * 16, 3)
    assert by_id[1][1] == by_id[2][1] == 1 and by_id[6][1] == by_id[7][1] == 6 and by_id[None][1] is None
    assert by_id[6][0] == f"{plain_fingerprint('one two'):016x}"
    assert simhash.simhash_components(empty(spark)).count() == 0


def test_rows_without_ids_link_others(spark):
    """Two documents that meet only through one that has no id."""
    text = " ".join(f"w{k}" for k in range(300))
    near = [text, text + " w300", text + " w300 w301 w302 w303 w304 w305 w306 w307 w308 w309"]
    fps = [plain_fingerprint(t) for t in near]
    rows = [(7, near[0]), (None, near[1]), (5, near[2]), (None, "alone")]
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["doc_id"]}
    group = plain_groups(fps)
    assert got[7] == (5 if group[2] == 0 else 7)


# general helpers

def test_join_per_key_with_one_heavy_value(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 4000, 1).when(F.col("id") < 4900, F.col("id")).cast("long").alias("k"))
    per_key = spark.createDataFrame([(1, "a"), (4500, "b"), (9, "c")], "k long, v string")
    got = join_per_key(rows, per_key, "k").groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"a": 4000, "b": 1, None: 999}


def test_whole_groups():
    import pyarrow as pa

    keys = [1] * 7 + [2] * 3 + [3] * 30 + [4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i:i + 4]}) for i in range(0, len(keys), 4)]
    parts = [t.column("k").to_pylist() for t in whole_groups(iter(batches), "k", 6)]
    assert sum(parts, []) == keys and all(not set(a) & set(b) for a, b in zip(parts, parts[1:])) and len(parts) > 1
    assert list(whole_groups(iter([]), "k", 6)) == []
