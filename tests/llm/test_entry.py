"""The driver's queries run on the smallest tables."""

import pytest

import corpus_pipeline
from starloom.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
