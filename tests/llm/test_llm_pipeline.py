"""The pipeline's stages keep clean documents and drop what they are for."""

import os

import corpus_pipeline
from millrace.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    exact = {r.doc_id for r in queries.QUERIES["op5_exact_dedup"](spark, SF_DIR).filter("kept").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), f"stage{k}")
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= before
        if name == "exact dedup":
            assert kept == exact
        before = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before
