"""Corpus pipeline over ``documents``, as query ``pipeline``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``: it takes what its
predecessor kept, written as Parquet and read again, and all but the last
return the columns of ``documents``. A null or empty text has no words: it is judged
by the classifiers' intercepts, is nobody's copy, holds no benchmark item and
encodes to nothing. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import quality, toxicity
from starloom.llm.decontaminate import without_contaminated
from starloom.llm.near_copies import one_of_each_group
from starloom.llm.queries import PIECES, table, tokenizer_file
from starloom.llm.sentencepiece_codec import codec_digests
from starloom.sinks.staging import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 5) predicts to be good."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.probability(spark, model)(F.col("text")) >= quality.THRESHOLD)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier (operator 4) does not predict to be toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.probability(spark, model)(F.col("text")) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies (operator 10)."""
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 8)."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What encoding each document to pieces and decoding it gives (operator 7)."""
    return codec_digests(docs, tokenizer_file(PIECES))


STAGES = [("quality", keep_quality), ("toxicity", drop_toxic), ("near_copies", drop_near_copies),
          ("decontamination", drop_contaminated), ("sentencepiece", encode)]

#: Trained classifiers and a tokenizer cannot be written in SQL; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
QUERY_ORACLES: dict[str, str] = {}
