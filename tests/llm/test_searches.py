import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, documents, empty, needs_tables, odd, words

from starloom.llm import decontaminate, vector_search
from starloom.llm.decontaminate import contaminations, without_contaminated
from starloom.llm.textblock import slices
from starloom.llm.vector_search import search_vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def _nearest(rows, query, k=10):
    """By brute force, over rows that differ in id or vector."""
    own = dict(rows)[query]
    best = {}
    for i, v in rows:
        if i != query:
            d = float(np.sqrt(((np.array(v, float) - np.array(own, float)) ** 2).sum()))
            best[i] = min(best.get(i, d), d)
    return sorted((d, i) for i, d in best.items())[:k]


def _answers(frame):
    out = defaultdict(list)
    for r in frame.collect():
        out[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_recall_with_many_lists(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = _answers(search_vectors(spark.createDataFrame([(*r, 0) for r in rows], VECTORS), list_size=32, block_rows=20))
    hit = total = 0
    for q in range(0, 4000, 100):
        want = _nearest(rows, q)
        hit += len({i for _, i in want} & {i for _, i in got[q]})
        total += len(want)
        exact = {i: d for d, i in _nearest(rows, q, 4000)}
        assert all(abs(d - exact[i]) < 1e-12 for d, i in got[q]) and got[q] == sorted(got[q]) and len(got[q]) == 10
    assert hit / total >= 0.9


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(1)
    c, x = rng.normal(size=(1500, 8)), rng.normal(size=(60, 8))
    ids, d = vector_search.CentroidGraph.build(c).search(x, 64)
    true = np.argsort(vector_search._squares(x, c), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, true)]) > 0.95
    assert np.allclose(d, np.sqrt(((c[ids] - x[:, None]) ** 2).sum(-1))) and (np.diff(d, axis=1) >= 0).all()


def test_equal_vectors_and_ties(spark):
    """A third of all rows share one vector: the smallest ids win, nothing is dropped."""
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(i, [float(i % 7), 2.0]) for i in range(300, 900)]
    got = _answers(search_vectors(spark.createDataFrame([(*r, 0) for r in rows], VECTORS), list_size=50, block_rows=16))
    assert set(got) == set(range(0, 900, 100))
    for q in got:
        assert got[q] == _nearest(rows, q)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0]),
            (None, [1.0, 1.0]), (7, []), (8, [1.0, 1.0, 1.0]), (100, [5.0, 5.0]), (6, [1.0, 2.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    assert _answers(search_vectors(df)) == {0: [(1.0, 6), (32 ** 0.5, 100)], 100: [(5.0, 6), (32 ** 0.5, 0)]}
    assert search_vectors(df.limit(0)).count() == 0
    assert search_vectors(df.where("vec_id = 0")).count() == 0


def _plain_edits(item, text):
    """The fewest word edits that turn the item into some stretch of the text."""
    row = [0] * (len(text) + 1)
    for k, w in enumerate(item, 1):
        new = [k]
        for j, v in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_closest_stretch_against_a_plain_table():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randrange(8) for _ in range(rng.randrange(4, 14))]
        text = [rng.randrange(8) for _ in range(rng.randrange(1, 30))]
        got = decontaminate.closest(np.array(item, np.uint64), np.array(text, np.uint64), len(item), 0)
        want = _plain_edits(item, text)
        if got is None:
            assert want == len(item)
        else:
            edits, a, b = got
            assert edits == want == _plain_edits(item, text[a:b])


def _edited(rng, item, pool, share):
    out = list(item)
    for _ in range(max(1, int(share * len(item)))):
        k = rng.randrange(len(out))
        if (kind := rng.randrange(3)) == 0:
            out[k] = rng.choice(pool)
        elif kind == 1:
            out.insert(k, rng.choice(pool))
        else:
            del out[k]
    return out


def test_recall_of_edited_items():
    rng = random.Random(5)
    pool = [f"w{int(rng.paretovariate(0.15)) % 5000}" for _ in range(4000)]
    items = [[rng.choice(pool) for _ in range(rng.randrange(16, 60))] for _ in range(120)]
    index = decontaminate.Index(list(range(120)), [" ".join(t) for t in items])
    for share, least in ((0.0, 1.0), (0.05, 0.95), (0.1, 0.9)):
        texts, want = [], []
        for k, item in enumerate(items):
            inside = _edited(rng, item, pool, share) if share else item
            texts.append(" ".join([rng.choice(pool) for _ in range(rng.randrange(90))] + inside + [rng.choice(pool) for _ in range(50)]))
            want.append(k)
        got = {(w.first_row + m[0], m[1]) for w in slices(pa.array(texts)) for m in index.matches(w)}
        assert sum((r, k) in got for r, k in enumerate(want)) >= least * len(want)


@pytest.mark.parametrize("place", ["start", "middle", "end", "spread"])
@pytest.mark.parametrize("share", [0.2, 0.25])
def test_recall_wherever_the_edits_are(place, share):
    rng = random.Random(6)
    pool = [f"w{int(rng.paretovariate(0.15)) % 5000}" for _ in range(4000)]
    for size in (12, 16, 24, 48, 59, 100, 200, 300):
        items = [[rng.choice(pool) for _ in range(size)] for _ in range(30)]
        index = decontaminate.Index(list(range(30)), [" ".join(t) for t in items])
        texts, n = [], int(share * size)
        for item in items:
            at = {"start": range(n), "middle": range((size - n) // 2, (size + n) // 2), "end": range(size - n, size),
                  "spread": rng.sample(range(size), n)}[place]
            inside = [f"new{rng.randrange(10 ** 6)}" if k in set(at) else v for k, v in enumerate(item)]
            texts.append(" ".join([rng.choice(pool) for _ in range(rng.randrange(90))] + inside + [rng.choice(pool) for _ in range(rng.randrange(90))]))
        got = {(w.first_row + m[0], m[1]) for w in slices(pa.array(texts)) for m in index.matches(w)}
        assert sum((k, k) in got for k in range(30)) >= 0.9 * 30, size


def _found(index, texts):
    return {(w.first_row + m[0], m[1]): m[4] for w in slices(pa.array(texts)) for m in index.matches(w)}


def test_short_items_against_a_plain_search():
    """Items of 5 to 19 words within a quarter of their words, by all kinds of edits, over a small vocabulary: every pair."""
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(60)]
    items = [[rng.choice(pool) for _ in range(size)] for size in range(5, 20) for _ in range(6)]
    texts = []
    for item in items:
        for share in (0.0, 0.15, 0.25, 0.4):
            texts.append([rng.choice(pool) for _ in range(rng.randrange(12))] + (_edited(rng, item, pool, share) if share else item)
                         + [rng.choice(pool) for _ in range(rng.randrange(12))])
    got = _found(decontaminate.Index(list(range(len(items))), [" ".join(t) for t in items]), [" ".join(t) for t in texts])
    want = {(r, k): e for r, t in enumerate(texts) for k, i in enumerate(items) if (e := _plain_edits(i, t)) <= len(i) // 4}
    assert got == want and len(want) > 200


def test_shortest_items_are_compared_with_whole_texts():
    items = ["Yes", "two words", "three words here", "exactly four words here"]
    texts = ["yes", "yes yes", "oh yes", "two  WORDS", "words two", "three words", "three words here", "exactly four words here",
             "exactly for words here", "exactly four here", "so exactly four words here", "so exactly for words here", "words here"]
    got = _found(decontaminate.Index([0, 1, 2, 3], items), texts)
    assert got == {(0, 0): 0, (3, 1): 0, (6, 2): 0, (7, 3): 0, (8, 3): 1, (9, 3): 1, (10, 3): 1}


@needs_tables
def test_matches_are_true_and_whole_items_are_found(spark):
    docs, benchmark = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: words(r["text"]) for r in benchmark.collect()}
    found = contaminations(docs, benchmark).collect()
    for r in found:
        stretch = words(texts[r["doc_id"]].encode()[r["start"]:r["end"]].decode())
        assert _plain_edits(items[r["item_id"]], stretch) == r["edits"] <= len(items[r["item_id"]]) // 4
    got = {(r["doc_id"], r["item_id"]) for r in found}
    joined = {i: " " + " ".join(words(t)) + " " for i, t in texts.items()}
    whole = {(i, k) for i, t in joined.items() for k, w in items.items() if " " + " ".join(w) + " " in t}
    assert whole and whole <= got and Counter(got).most_common(1)[0][1] == 1
    left = {r["doc_id"] for r in without_contaminated(docs, benchmark).collect()}
    assert left == set(texts) - {i for i, _ in got}


def test_short_odd_and_empty_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)  # several blocks
    benchmark = spark.createDataFrame([(1, "words HERE again the same"), (2, "b c d e f g"), (3, None), (4, ""), (5, "the"), (None, "b c d e f g"),
                                       (6, "five words here again"), (7, "b c d e f g")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in contaminations(odd(spark), benchmark).collect()}
    assert got == {(9, 2, 0), (9, 7, 0)}
    text = spark.createDataFrame([(1, "the the same five Words here again THE same")], "doc_id long, text string")
    assert [(r["item_id"], r["start"], r["end"]) for r in contaminations(text, benchmark).collect()] == [(1, 18, 43)]
    assert contaminations(empty(spark), benchmark).count() == 0
    assert contaminations(odd(spark), benchmark.limit(0)).count() == 0
    kept = without_contaminated(odd(spark), benchmark)
    assert kept.columns == odd(spark).columns and kept.count() == 10
