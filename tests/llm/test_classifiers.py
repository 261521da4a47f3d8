import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import empty, labels, odd

from starloom.llm import quality, toxicity
from starloom.llm.textblock import slices
from starloom.llm.training_rows import labelled_sample

MID = "/root/testdata/sf0.01"


def _held_out(spark, frame, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = [r for r in frame.collect() if r["held_out"] and r["doc_id"] in truth]
    y = np.array([truth[r["doc_id"]] for r in rows])
    p = np.array([r["score"] for r in rows])
    rank = np.argsort(np.argsort(p))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum()), np.mean([r["predicted"] for r in rows] == y)


def _tables(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


def test_quality_held_out(spark):
    got = quality.quality_scores(*_tables(spark))
    area, right = _held_out(spark, got, "quality")
    assert area > 0.97 and right > 0.95
    for r in got.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_toxicity_held_out(spark):
    got = toxicity.toxicity_scores(*_tables(spark))
    area, right = _held_out(spark, got, "toxic")
    assert area > 0.75 and right > 0.8
    for r in got.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_labels_of_held_out_rows_are_not_learned(spark):
    """Turning the held-out labels round changes no score."""
    docs, known = _tables(spark)
    rows = [(r["doc_id"], r["quality"], r["toxic"]) for r in known.collect()]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in rows]
    a = quality.train(docs, labels(spark, rows))
    b = quality.train(docs, labels(spark, turned))
    assert a[1] == b[1] and np.array_equal(a[0], b[0])


def test_misspelt_words_share_the_vectors_of_known_ones():
    rng = np.random.default_rng(0)
    plain = [f"w{k}ord" for k in range(400)]
    texts, doc, y = [], [], []
    for d in range(120):
        bad = d % 2
        for _ in range(12):
            w = list(rng.choice(plain, 4))
            texts.append(" ".join(w))
            doc.append(d)
            y.append(bad)
        if bad:
            texts[-1] = "horrible " + texts[-1]
    margin, bias = toxicity.fit(pa.array(texts), np.array(doc), np.array(y))
    clean = " ".join(rng.choice(plain, 60))
    z = toxicity.text_margins(pa.array([clean, clean + " horrible " + clean, clean + " horribble " + clean]), margin, bias)
    assert z[1] > z[0] + 2 and z[2] > z[0] + 1


def test_every_window_of_a_long_text_is_learned_from(spark, monkeypatch):
    """A passage that is in toxic texts only: 12 of 2,000 words, which lie between evenly spread windows."""
    monkeypatch.setattr(toxicity, "PART_BYTES", 100_000, raising=False)  # several parts
    rng = np.random.default_rng(2)
    rows = []
    for i in range(160):
        text = [f"w{k}ord" for k in rng.integers(0, 300, 2000)]
        if i % 2:
            text[6:18] = rng.choice(["horrible", "vile", "disgusting", "filthy", "scum", "hateful"], 12)
        rows.append((i, " ".join(text)))
    known = labels(spark, [(i, 0, i % 2) for i, _ in rows])
    margin, bias = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), known)
    z = toxicity.text_margins(pa.array(["w1ord w2ord w3ord w4ord", "vile hateful filthy scum"]), margin, bias)
    assert z[1] > z[0] + 2


def test_windows_are_means_over_words_of_means_over_ngrams():
    texts = ["Ab cde ab x Stupid, é one two three", "", None, "ab ab"]
    bags = toxicity.Bags()
    assert bags.add(pa.array(texts), 4).tolist() == [0, 0, 0, 3]
    own, slot, weight = bags.close().take(np.arange(4))
    margin = np.random.default_rng(1).normal(size=1 << toxicity.BITS)
    plain = [toxicity.word_margins(w, margin).mean() for t in ("Ab cde ab x", "Stupid, é one two", "three", "ab ab") for w in slices(pa.array([t]))]
    assert np.allclose(bags.means(margin), plain) and np.allclose(np.bincount(own, margin[slot] * weight), plain, atol=1e-6)


def test_subwords_against_a_plain_count():
    w = next(slices(pa.array(["Ab cde", None, "x stupid, é"])))
    slot, n = toxicity.subwords(w)
    grams = lambda x: sum(max(0, len(x.encode()) + 2 - k + 1) for k in (3, 4, 5))
    assert n.tolist() == [grams(x) for x in ("Ab", "cde", "x", "stupid,", "é")] and len(slot) == n.sum()
    again, m = toxicity.subwords(next(slices(pa.array(["CDE"]))))
    assert sorted(again) == sorted(slot[n[0]:n[0] + n[1]])


def test_sparse_rows_score_as_logits():
    texts = pa.array(["one two two two", None, "", "ONE!! TWO!! %%%", "a " * 5000])
    rng = np.random.default_rng(1)
    weights = rng.normal(size=1 << quality.BITS).astype(np.float32)
    dots = [weights[s].astype(float) @ v.astype(float) + 0.5 for s, v in quality.sparse_rows(texts)]
    assert np.allclose(dots, quality.logits(texts, weights, 0.5), rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
@pytest.mark.parametrize("known", [[], [(1, 1, 1), (2, 1, 1)], [(1, 1, 1), (6, 0, 0), (6, None, 1), (None, 1, 0), (8, 5, 5), (9, 0, 1)]])
def test_odd_rows(spark, score, known):
    got = score(odd(spark), labels(spark, known)).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    same = {r["score"] for r in got if r["doc_id"] in (1, 2)}
    assert len(same) == 1
    assert score(empty(spark), labels(spark, known)).count() == 0


def test_sample_is_bounded_and_takes_both_classes(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    known = spark.range(500).selectExpr("id AS doc_id", "cast(id % 5 = 0 AS int) AS quality", "0 AS toxic")
    got = labelled_sample(docs, known.union(known), "quality", known["doc_id"] >= 0, rows_per_class=30).collect()
    assert len(got) == 60 and sum(r["label"] for r in got) == 30


def test_labels_of_other_documents_do_not_use_up_the_sample(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    known = spark.range(50_000).selectExpr("id AS doc_id", "cast(id % 5 = 0 AS int) AS quality", "0 AS toxic")
    got = labelled_sample(docs, known, "quality", known["doc_id"] >= 0, rows_per_class=30).collect()
    assert len(got) == 60 and sum(r["label"] for r in got) == 30
