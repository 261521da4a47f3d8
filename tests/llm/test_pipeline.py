import numpy as np
import pyarrow as pa
from helpers import SF, documents, needs_tables, plain_components, words

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import quality, toxicity
from starloom.llm.queries import PIECES, tokenizer_file


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(entry.oracle_sql()) <= names


@needs_tables
def test_pipeline_against_a_plain_version(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    def scores(module, logits, kept):
        model = module.train(docs.where(docs["doc_id"].isin(list(kept))), labels)
        z = logits(pa.array([rows[i] for i in kept]), *model)
        return dict(zip(kept, 1 / (1 + np.exp(-z))))

    kept = sorted(rows)
    kept = [i for i, p in scores(quality, quality.logits, kept).items() if p >= 0.3]
    kept = [i for i, p in scores(toxicity, toxicity.text_margins, kept).items() if p < 0.3]
    assert kept
    kept = [i for i, (_, c) in plain_components([(i, rows[i]) for i in kept]).items() if c == i]
    items = [" " + " ".join(words(r["text"])) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [i for i in kept if not any(t in " " + " ".join(words(rows[i])) + " " for t in items)]

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECES))
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    # edited copies of items go too; the plain version only knows whole ones
    assert set(got) <= set(kept) and len(got) >= len(kept) - 5
    assert all(got[i] == len(sp.encode(rows[i])) for i in got)


@needs_tables
def test_stages_keep_the_columns(spark):
    docs = documents(spark).selectExpr("*", "1 AS score", "'x' AS sid")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [*documents(spark).columns, "score", "sid"]
    assert docs.count() > 0
