import itertools
import random
import zlib

import numpy as np
from helpers import LONG, documents, empty, needs_tables, odd

from starloom.llm import sentencepiece_codec as codec
from starloom.llm.queries import BYTE_BPE, PIECES, tokenizer_file
from starloom.llm.token_counts import token_counts

_PARTS = [" ", "  ", "▁", "\n", "\t", "a", "the", "é", "中", "😀", "<0x0A>", "<s>", "ing", ".", "\0", "\xa0", "A", "TH", "1", "23", "'s",
          "<|endoftext|>", "\r\n", "ñ", "ß", "    ", "\x1c", "\x85", " x", "y ", "it is"]


def _texts():
    rng = random.Random(1)
    return ["".join(rng.choice(_PARTS) for _ in range(rng.randrange(30))) for _ in range(1500)] + ["", "a" * 300, " " * 99 + "x", LONG[:20000]]


def _library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECES))


def test_ids_and_texts_are_the_librarys():
    own, sp, texts = codec.codec(tokenizer_file(PIECES)), _library(), _texts()
    for text, ids in zip(texts, own.encode(texts)):
        want = sp.encode(text)
        assert np.frombuffer(ids, "<i4").tolist() == want
        assert own.decode(np.array(want)) == sp.decode(want)


def test_long_runs_of_spaces_take_no_square_of_steps():
    import time

    own, sp = codec.codec(tokenizer_file(PIECES)), _library()
    texts = [" " * n + end for n in (2, 3, 17, 1000, 20_001) for end in ("", "x", "the end")] + ["a" + "  " * 5000 + "b", "▁" * 4097]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == sp.encode(text)
    started = time.process_time()
    assert own.encode([" " * 1_000_000])[0]
    assert time.process_time() - started < 60


def test_merging_against_the_plain_way():
    own = codec.codec(tokenizer_file(PIECES)).forward
    rng = random.Random(4)

    def plain(word):
        symbols, parts = list(word), None
        while True:
            best = max(((own.score[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in own.score), default=None)
            if best is None:
                return symbols, parts
            i = -best[1]
            parts = (symbols[i], symbols[i + 1])
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]

    pool = list(own.score)[:3000]
    for _ in range(2000):
        word = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 6)))
        assert own.merged(word) == plain(word), word


def test_store_that_overflows_gives_the_same(monkeypatch):
    own = codec.Codec(codec.Pieces(tokenizer_file(PIECES)))
    texts = _texts()[:400]
    want = own.encode(texts)
    monkeypatch.setattr(codec, "KEPT_WORDS", 20)
    assert [own.encode([t])[0] for t in texts] == want


def test_unigram_forward_is_the_best_segmentation():
    class Small:
        score = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.2, "aba": -4.1, "c": -3.0, "bc": -4.0}
        longest = 3

    forward, states, before = codec.UnigramForward(Small), [], ""
    cost = lambda parts: sum(Small.score.get(p, forward.unknown) for p in parts)
    for word in sorted("".join(w) for n in range(1, 6) for w in itertools.product("abcx", repeat=n)):
        same = next((k for k, (x, y) in enumerate(zip(before, word)) if x != y), min(len(before), len(word)))
        del states[same:]
        forward.extend(word, states)
        best = max(cost([word[i:j] for i, j in zip((0, *cuts), (*cuts, len(word)))])
                   for n in range(len(word)) for cuts in itertools.combinations(range(1, len(word)), n)
                   if all(j - i == 1 or word[i:j] in Small.score for i, j in zip((0, *cuts), (*cuts, len(word)))))
        assert abs(cost(forward.segments(word, states)) - best) < 1e-9 and "".join(forward.segments(word, states)) == word
        before = word


@needs_tables
def test_round_trip_over_documents(spark):
    sp = _library()
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    encoded = codec.encode_texts(docs, tokenizer_file(PIECES)).cache()
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {i: sp.encode(t) for i, t in texts.items()}
    back = {r["doc_id"]: r["text"] for r in codec.decode_ids(encoded, tokenizer_file(PIECES)).collect()}
    assert back == texts
    for r in codec.codec_digests(docs, tokenizer_file(PIECES)).collect():
        ids = np.array(sp.encode(texts[r["doc_id"]]), "<i4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        assert r["round_trip"] and r["decoded_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())


def test_odd_rows(spark):
    got = codec.codec_digests(odd(spark), tokenizer_file(PIECES)).collect()
    assert len(got) == 11 and all(r["round_trip"] for r in got)
    assert {r["doc_id"]: r["n_tokens"] for r in got}[3] == 0
    assert codec.codec_digests(empty(spark), tokenizer_file(PIECES)).count() == 0


def _counts(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file(BYTE_BPE))
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_counts_are_the_librarys(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in token_counts(docs, tokenizer_file(BYTE_BPE)).collect()}
    want = _counts(texts)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == want
    assert all(got[i]["n_bytes"] == len(t.encode()) and got[i]["over_limit"] == (n > 1024) for i, (t, n) in enumerate(zip(texts, want)))


def test_cache_is_used_and_grows(spark, tmp_path):
    path, model = str(tmp_path / "cache"), tokenizer_file(BYTE_BPE)
    first = spark.createDataFrame([(1, "some words"), (2, "some words"), (3, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts(first, model, cache_path=path).collect()} == {1: 2, 2: 2, 3: 0}
    assert spark.read.parquet(path).count() == 2
    more = spark.createDataFrame([(4, "some words"), (5, "others")], "doc_id long, text string")
    assert token_counts(more, model, cache_path=path).count() == 2
    assert spark.read.parquet(path).count() == 3


def test_token_counts_of_odd_rows(spark):
    got = token_counts(odd(spark), tokenizer_file(BYTE_BPE)).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted(
        (i or 0, n) for (i, *_), n in zip(odd(spark).collect(), _counts([r["text"] for r in odd(spark).collect()])))
    assert token_counts(empty(spark), tokenizer_file(BYTE_BPE)).count() == 0
