"""SentencePiece encoding and decoding by a forward pass shared along common prefixes.

Text becomes marked words: a space is the mark ``U+2581`` and begins the word
after it; a character that no longer piece contains stands alone. The distinct
words of a batch that were not met before are sorted, which lays them out as a
trie in depth-first order: going from one word to the next, the forward states
of their common prefix are kept and only the rest is computed.

The forward state of a prefix depends on the kind of model:

* unigram: the best score and the last piece of the best segmentation (Viterbi);
* BPE: merges are greedy, so the highest sum of scores is not what the library
  gives. But the last piece of the BPE segmentation of each prefix is unique:
  the one whose predecessor is the last piece of the shorter prefix, with no
  merge across the seam coming before the merges that made the two. That is a
  forward state of the same shape, and gives the library's ids exactly.

Everything happens within a batch: no shuffle, memory bounded by the batch and
by a store of at most ``KEPT_WORDS`` words in each Python worker.

Defined results: a null or empty text has no ids and decodes to the empty
text. ``U+2581`` in a text decodes to a space, as the library has it. Repeated
rows each get a row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words whose ids a Python worker keeps, twice: beyond that, those not met lately go.
KEPT_WORDS = 200_000

_UNIGRAM, _BPE = 1, 2
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of the fields of an encoded protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if tag & 7 == 1 else (4, at) if tag & 7 == 5 else _varint(data, at)
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class Pieces:
    """The pieces, scores and settings of a model that normalises nothing but spaces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = dict(_fields(sp.serialized_model_proto()))
        trainer, normalizer = dict(_fields(proto[2])), dict(_fields(proto[3]))
        self.kind = trainer.get(3, _UNIGRAM)
        if normalizer.get(1, b"") != b"identity" or normalizer.get(4, 1):
            raise ValueError("only models with the identity normaliser that keep extra spaces are read")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: sp.get_score(i) for i in plain}
        self.unknown = sp.unk_id()
        self.byte = {int(self.text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece has the space mark after another character")
        self.decoded = [b"" if sp.is_control(i) else bytes([int(t[3:5], 16)]) if sp.is_byte(i)
                        else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        self.longest = max(map(len, self.id))

    def ids(self, piece: str) -> list[int]:
        """Of a piece, or of a character that is none: its bytes."""
        found = self.id.get(piece)
        if found is not None:
            return [found]
        return [self.byte[b] for b in piece.encode()] if self.byte else [self.unknown]


class BpeForward:
    """Last piece of the BPE segmentation of each prefix of a word."""

    def __init__(self, pieces: Pieces):
        self.score = pieces.score
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.seams: dict[tuple[str, str], bool] = {}
        #: Lengths of the pieces that end in two given characters; one character is always a piece.
        self.lengths: dict[str, list[int]] = {}
        for piece in sorted(self.score, key=len):
            if len(piece) > 1:
                found = self.lengths.setdefault(piece[-2:], [1])
                if found[-1] != len(piece):
                    found.append(len(piece))

    def merged(self, word: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain BPE of a string, best score first, then leftmost; and the parts of the last merge.

        Symbols are a linked list, the merges that can be made a heap, so a long run of marks takes ``n log n`` steps.
        """
        symbols: list[str | None] = list(word)
        after, before, parts = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1)), None
        heap = [(-self.score[a + b], i, a + b) for i, (a, b) in enumerate(zip(word, word[1:])) if a + b in self.score]
        heapify(heap)

        def offer(i: int) -> None:
            both = symbols[i] + symbols[after[i]]
            if both in self.score:
                heappush(heap, (-self.score[both], i, both))

        while heap:
            _, i, both = heappop(heap)
            j = after[i]
            if symbols[i] is None or j == len(word) or symbols[i] + symbols[j] != both:
                continue  # one of the two was merged with another meanwhile
            parts = (symbols[i], symbols[j])
            symbols[i], symbols[j], after[i] = both, None, after[j]
            if after[i] < len(word):
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s is not None], parts

    def _parts(self, piece: str) -> tuple[str, str] | None:
        """What a piece was merged from last; None for one character or a piece that merging never makes."""
        if piece not in self.parts:
            symbols, parts = self.merged(piece)
            self.parts[piece] = parts if len(symbols) == 1 else None
        return self.parts[piece]

    def _seam_holds(self, left: str, right: str) -> bool:
        """Whether no merge crosses the seam between two pieces while they are being made."""
        key = (left, right)
        if key in self.seams:
            return self.seams[key]
        lefts, rights = [left], [right]          # what stands at the seam, latest first
        while parts := self._parts(lefts[-1]):
            lefts.append(parts[1])
        while parts := self._parts(rights[-1]):
            rights.append(parts[0])
        i, j, score, holds = len(lefts) - 1, len(rights) - 1, self.score, True
        while True:
            across = score.get(lefts[i] + rights[j])
            grow_left = score[lefts[i - 1]] if i else None
            grow_right = score[rights[j - 1]] if j else None
            # at equal scores the leftmost merge goes first
            if across is not None and (grow_left is None or across > grow_left) and (grow_right is None or across >= grow_right):
                holds = False
                break
            if grow_left is None and grow_right is None:
                break
            if grow_right is None or grow_left is not None and grow_left >= grow_right:
                i -= 1
            else:
                j -= 1
        self.seams[key] = holds
        return holds

    def extend(self, word: str, states: list[str]) -> None:
        """Append the states of the prefixes of ``word`` that are longer than those known."""
        score, seams, parts, lengths = self.score, self.seams, self.parts, self.lengths
        for end in range(len(states) + 1, len(word) + 1):
            for size in lengths.get(word[end - 2:end], (1,)) if end > 1 else (1,):
                begin = end - size
                if begin < 0:
                    continue
                piece = word[begin:end]
                if size > 1 and (piece not in score or (parts[piece] if piece in parts else self._parts(piece)) is None):
                    continue
                if begin:
                    holds = seams.get((states[begin - 1], piece))
                    if holds is None:
                        holds = self._seam_holds(states[begin - 1], piece)
                    if not holds:
                        continue
                states.append(piece)
                break

    def segments(self, word: str, states: list[str]) -> list[str]:
        out, end = [], len(word)
        while end:
            out.append(states[end - 1])
            end -= len(out[-1])
        return out[::-1]


class UnigramForward:
    """Best score and last piece of each prefix (Viterbi); a character that is no piece costs the most."""

    def __init__(self, pieces: Pieces):
        self.score, self.longest = pieces.score, pieces.longest
        self.unknown = min(self.score.values()) - 10.0

    def extend(self, word: str, states: list[tuple[float, str]]) -> None:
        for end in range(len(states) + 1, len(word) + 1):
            best = None
            for begin in range(max(0, end - self.longest), end):
                piece = word[begin:end]
                score = self.score.get(piece, self.unknown if end - begin == 1 else None)
                if score is not None:
                    total = score + (states[begin - 1][0] if begin else 0.0)
                    if best is None or total > best[0]:
                        best = (total, piece)
            states.append(best)

    def segments(self, word: str, states: list[tuple[float, str]]) -> list[str]:
        out, end = [], len(word)
        while end:
            out.append(states[end - 1][1])
            end -= len(out[-1])
        return out[::-1]


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forward = BpeForward(pieces) if pieces.kind == _BPE else UnigramForward(pieces)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.ids: dict[str, bytes] = {}
        self.simple = self.pieces.dummy_prefix and not any("\n" in p for p in pieces.id)

    def words(self, text: str) -> list[str]:
        """Marked words, each without its mark if that is its first character, else after a NUL.

        A line break joins nothing, so it may begin a word of its own.
        """
        if not text:
            return []
        if self.simple and not (text[0] == " " or "  " in text or MARK in text or "\0" in text):
            return text.replace("\n", " \n").split(" ")
        marked = (MARK if self.pieces.dummy_prefix else "") + text.replace(" ", MARK)
        return ["\0" + w for w in _WORD.findall(marked)]

    @staticmethod
    def _marked(key: str) -> str:
        return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else MARK + key

    def _learn(self, keys: list[str]) -> None:
        """Ids of new words: depth-first through the trie that their order makes."""
        before, states, ids = "", [], self.ids
        for word, key in sorted((self._marked(k), k) for k in keys):
            if self.pieces.kind == _BPE and word.startswith(MARK * 2):
                # pieces of marks alone share one score: merge them one by one
                segments = self.forward.merged(word)[0]
            else:
                same = 0
                for a, b in zip(before, word):
                    if a != b:
                        break
                    same += 1
                del states[same:]
                self.forward.extend(word, states)
                segments, before = self.forward.segments(word, states), word
            for s in segments:
                if s not in ids:
                    ids[s] = np.array(self.pieces.ids(s), "<i4").tobytes()
            self.known[key] = b"".join([ids[s] for s in segments])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if len(self.known) > KEPT_WORDS:
            self.known, self.before = {}, self.known
            if len(self.ids) > KEPT_WORDS:
                self.ids = {}
            if isinstance(self.forward, BpeForward) and len(self.forward.seams) > 2 * KEPT_WORDS:
                self.forward.seams.clear()
        known, rows, missing = self.known, [], set()
        for t in texts:
            words = self.words(t)
            ids = list(map(known.get, words))
            new = [(k, words[k]) for k, found in enumerate(ids) if found is None] if None in ids else ()
            missing.update(w for _, w in new)
            rows.append((ids, new))
        known.update((w, self.before[w]) for w in missing & self.before.keys())
        self._learn([w for w in missing if w not in known])
        for ids, new in rows:
            for k, w in new:
                ids[k] = known[w]
        return [b"".join(ids) for ids, _ in rows]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        data = b"".join(map(self.pieces.decoded.__getitem__, ids.tolist()))
        if self.pieces.dummy_prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(Pieces(path))
    return _codecs[path]


def _groups(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    begin = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield begin, texts[begin:k + 1]
            begin, size = k + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


_ARROW = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}


def _over(docs: DataFrame, model_path: str, schema: str, row: Callable[[Codec, str, bytes], tuple]) -> DataFrame:
    names, kinds = zip(*(f.split() for f in schema.split(",")))
    kinds = [_ARROW[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for begin, group in _groups(texts):
                got = [row(own, t, ids) for t, ids in zip(group, own.encode(group))]
                cols = [batch.column("doc_id").slice(begin, len(group)), *map(list, zip(*got))]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(cols, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text."""
    return _over(docs, model_path, "doc_id long, ids array<int>",
                 lambda own, text, ids: (np.frombuffer(ids, "<i4"),))


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``ids``; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def codec_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: what encoding its text and decoding the ids gave.

    ``n_tokens``; ``ids_crc32`` of the ids as little-endian 32-bit integers;
    ``decoded_crc32`` of the decoded text as UTF-8; ``round_trip``: whether that
    is the text again, spaces and ``U+2581`` taken as one.
    """
    def row(own: Codec, text: str, ids: bytes) -> tuple:
        back = own.decode(np.frombuffer(ids, "<i4"))
        return len(ids) // 4, zlib.crc32(ids), zlib.crc32(back.encode()), back == text.replace(MARK, " ")

    return _over(docs, model_path, "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean", row)
