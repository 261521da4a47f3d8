"""Registered queries of this subpackage: each applies one operator to its whole table.

The operators take DataFrames; the queries read the tables, set the production
parameters and derive the columns that are compared. Files of public tokenizers
are looked up by name in the installed package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.decontaminate import contaminations
from starloom.llm.near_copies import near_copy_components
from starloom.llm.ngram_model import language_scores
from starloom.llm.quality import quality_scores
from starloom.llm.sentencepiece_codec import codec_digests
from starloom.llm.sharding import shard_documents
from starloom.llm.simhash import simhash_components
from starloom.llm.spelling import spelling_of_documents
from starloom.llm.token_counts import token_counts
from starloom.llm.toxicity import toxicity_scores
from starloom.llm.url_filter import judge_urls
from starloom.llm.vector_codes import compressed_codes
from starloom.llm.vector_search import search_vectors

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by Spark's reader alone, whatever store the folder is in."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector among all vectors."""
    return search_vectors(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return language_scores(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to ids and decoded again."""
    return codec_digests(table(spark, sf_dir, "documents"), tokenizer_file(PIECES))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a fresh digest cache."""
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_BPE))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_copy_components(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as the codes of its parts."""
    return compressed_codes(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of all documents."""
    return spelling_of_documents(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and group of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_search": op1_vector_search,
    "op2_url_filter": op2_url_filter,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_simhash": op13_simhash,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _vector_codes_sql(rounds: int = 4) -> str:
    """Refinement round by round: distances of all parts to all entries, nearest entry, rounded-down means."""
    q = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k, vec_id, label,
         [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
"""part AS MATERIALIZED (
  SELECT k, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS v FROM kept, range(4) AS r(p))""",
"book0 AS MATERIALIZED (SELECT p, k - 1 AS e, v FROM part WHERE k <= 256)"]
    for r in range(rounds + 1):
        q.append(f"""near{r} AS MATERIALIZED (
  SELECT k, p, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT a.k, a.p, b.e, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(a.v, b.v)]) AS d
    FROM part a JOIN book{r} b ON a.p = b.p) GROUP BY k, p)""")
        if r < rounds:
            q.append(f"""mean{r} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT p, e, i, CAST(floor(sum(x) / CAST(count(*) AS DECIMAL(38, 0))) AS BIGINT) AS m FROM (
      SELECT a.p, n.best.e AS e, unnest(a.v) AS x, unnest(range(len(a.v))) AS i FROM part a JOIN near{r} n ON a.k = n.k AND a.p = n.p)
    GROUP BY p, e, i) GROUP BY p, e)""")
            q.append(f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)")
    q.append(f"""coded AS (
  SELECT k, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY k)""")
    q.append(f"digest AS (SELECT sha256(string_agg(x, ',' ORDER BY p, e)) AS s FROM (SELECT p, e, array_to_string(v, ',') AS x FROM book{rounds}))")
    return "WITH " + ",\n".join(q) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM kept JOIN coded USING (k), digest"""


#: DuckDB statements for the queries that SQL can express.
QUERY_ORACLES: dict[str, str] = {
    "op10_ngram_jaccard": f"""
WITH RECURSIVE
words AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT k, doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words),
grams AS (SELECT k, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.k AS a, y.k AS b FROM grams x JOIN grams y ON x.g = y.g AND x.k <> y.k
  GROUP BY x.k, y.k, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
  SELECT k AS a, k AS b FROM words
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM sets s JOIN (SELECT a, min(doc_id) AS component_id FROM reach JOIN words ON k = b GROUP BY a) m ON m.a = s.k""",
    "op11_vector_codes": _vector_codes_sql(),
    "op12_spelling_variants": f"""
WITH RECURSIVE
crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) AS r(i)),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY doc_id, run),
hashed AS MATERIALIZED (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(h) // 2)]),
                                     lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs), crc_table),
counts AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, times FROM hashed)
  WHERE len(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
less AS MATERIALIZED (
  SELECT word, n, CAST(i AS BIGINT) AS i, word[1:i - 1] || word[i + 1:] AS rest FROM counts, range(1, len(word) + 1) AS r(i)),
near AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION ALL SELECT x.word, x.n, y.word, y.n FROM less x JOIN counts y ON x.rest = y.word
    UNION ALL SELECT y.word, y.n, x.word, x.n FROM less x JOIN counts y ON x.rest = y.word)),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS b FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * c.n THEN b.other END AS form, CASE WHEN -b.less >= 2 * c.n THEN -b.less END AS form_n
  FROM counts c LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS last, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)""",
}
