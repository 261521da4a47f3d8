"""Token counts with a digest cache.

A text's key is the SHA-256 digest of its normalised content together with the
digest of the tokenizer's version (its file and the library). Counts are looked
up by key in a cache table; only the distinct keys that miss are encoded, and
their counts are appended to the cache. Normalising means that null counts as
the empty text: anything more would change what the library counts.

Only keys are grouped, so a text that a third of all rows repeat costs one
partial row per task. The texts of the misses travel once, by id and digest, to
where they are encoded; the digest of a hot text is then met by one row alone.

A text is encoded in units: a space or line break with what follows it up to
the next one. The byte-level pattern always breaks before white space that
follows something else, so the units' counts add up to the text's, and a unit
met before is not encoded again (a bounded store in each Python worker). Texts
with runs of white space, other space characters or a special token's string
are split more carefully or encoded whole.

Defined results: null and empty texts count 0; repeated rows each get a row.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sinks.staging import staging_path

LIMIT = 1024
#: Units whose counts a Python worker keeps, twice: beyond that, those not met lately go.
KEPT_UNITS = 500_000

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"

_UNIT = re.compile("[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_NOT_SIMPLE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]|[ \n]{2}")
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class UnitCounter:
    """Counts tokens of texts by their units."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> Iterator[int]:
        for a in range(0, len(texts), 2000):
            for e in self.tokenizer.encode_batch_fast(texts[a:a + 2000], add_special_tokens=False):
                yield len(e)

    def units(self, text: str) -> list[str] | None:
        """Keys of a text's units: a unit without its space, if it begins with one, else it after a NUL.

        None if the text must be encoded whole.
        """
        if any(s in text for s in self.special) or "\0" in text:
            return None
        if not _NOT_SIMPLE.search(text):
            units = text.replace("\n", " \n").split(" ")
            units[0] = "\0" + units[0]
            return units
        if _OTHER_SPACE.search(text):
            return None
        return [u[1:] if u[0] == " " and u[1:2] != "\n" else "\0" + u for u in _UNIT.findall(text)]

    @staticmethod
    def _text(key: str) -> str:
        return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key

    def counts(self, texts: list[str]) -> list[int]:
        """The token count of each whole text."""
        if len(self.known) > KEPT_UNITS:
            self.known, self.before = {}, self.known
        get, out, rest = self.known.get, [], []
        for t in texts:
            units = self.units(t)
            if units is None:
                out.append(next(self._encode([t])))
                rest.append(())
                continue
            got = list(map(get, units))
            new = [u for u, n in zip(units, got) if n is None] if None in got else ()
            out.append(sum(n for n in got if n is not None) if new else sum(got))
            rest.append(new)
        missing = set().union(*rest)
        known = self.known
        known.update((u, self.before[u]) for u in missing & self.before.keys())
        missing = [u for u in missing if u not in known]
        known.update(zip(missing, self._encode([self._text(u) for u in missing])))
        return [n + sum(map(known.__getitem__, new)) for n, new in zip(out, rest)]


_counters: dict[str, UnitCounter] = {}


def _groups(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Successive texts of about ``most`` characters together."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(path, UnitCounter(path)) if path not in _counters else _counters[path]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [c for group in _groups(texts) for c in counter.counts(group)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer_path: str, *, cache_path: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``cache_path`` is a folder of earlier counts (``CACHE_SCHEMA``) on shared
    storage, which this appends to; where it is None a fresh one is begun in
    the session's checkpoint folder. The tokenizer file must be at the same
    place on every machine.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    path = cache_path or staging_path(spark, "token-counts")
    # an empty append makes the folder readable when it is new
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    cached = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version)

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    keys = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    chosen = keys.groupBy("digest").agg(F.min("doc_id").alias("chosen"))
    misses = chosen.join(cached.select("digest"), "digest", "left_anti").withColumnRenamed("digest", "missed")
    todo = rows.join(misses.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("chosen"))
                     & (F.col("digest") == F.col("missed")), "left_semi")
    (todo.select("digest", "text").mapInArrow(_count(tokenizer_path), "digest binary, n_tokens long")
     .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(path))

    counts = (spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return keys.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
