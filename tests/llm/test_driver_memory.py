import pytest
from helpers import SF, documents, needs_tables

from starloom.llm import quality, toxicity


@needs_tables
@pytest.mark.parametrize("module", [quality, toxicity])
def test_training_gives_the_drivers_memory_back(spark, monkeypatch, module):
    given = []
    monkeypatch.setattr(module, "release_memory", lambda: given.append(module))
    module.train(documents(spark), spark.read.parquet(f"{SF}/labels.parquet"))
    assert given
