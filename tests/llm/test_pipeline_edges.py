"""The pipeline's stages on empty tables, null columns and very long texts."""

import numpy as np
import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert found.count() == 0 and found.columns[: len(docs.columns)] == docs.columns


def test_null_columns_and_a_long_text_pass_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"w{k}" for k in np.random.default_rng(1).integers(0, 40_000, 120_000))
    more = [(None, "a text without a key or a language", None, None, None), (90_001, None, None, None, None), (90_002, long, "en", None, None)]
    docs = docs.limit(200).unionByName(spark.createDataFrame(more, docs.schema))
    for name, stage_of in corpus_pipeline.STAGES[:3]:
        docs = stage_of(spark, docs, SF).cache()
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert {None, 90_001, 90_002} <= ids, name
    assert docs.where("doc_id = 90002").first()["text"] == long
    coded = dict(corpus_pipeline.STAGES)["bpe"](spark, docs, SF)
    sizes = {r["doc_id"]: len(r["ids"]) for r in coded.where("doc_id > 90000").collect()}
    assert sizes[90_001] == 0 and sizes[90_002] > 120_000
