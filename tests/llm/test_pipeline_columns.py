"""Stages of the pipeline on tables with awkward columns, without rows, and with repeated ids."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DATA = "/root/testdata/sf0.001"
ADDED = ["score", "lang_pred", "languages", "spans", "n_words", "n_removed", "kept_text", "features", "ids", "n_tokens", "_dropped", "_hit", "kept"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").limit(60).cache()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_columns_with_the_names_of_added_ones_stay(spark, docs, name, stage):
    named = docs.withColumns({c: F.lit(f"own {c}") for c in ADDED})
    plain = {r.doc_id: tuple(r) for r in stage(spark, docs, DATA).collect()}
    out = stage(spark, named, DATA)
    assert out.columns == named.columns
    found = out.collect()
    assert {r.doc_id: tuple(r)[: len(docs.columns)] for r in found} == plain
    assert all(r[c] == f"own {c}" for r in found for c in ADDED)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_no_rows_and_on_two_columns(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), DATA).count() == 0
    assert stage(spark, docs.select("doc_id", "text", "lang").limit(0), DATA).count() == 0


def test_repeated_ids_are_one_document(spark, docs):
    twice = docs.union(docs.where("doc_id = 3"))
    kept = corpus_pipeline.near_duplicates(spark, twice, DATA)
    once = corpus_pipeline.near_duplicates(spark, docs, DATA)
    n = once.where("doc_id = 3").count()
    assert kept.where("doc_id = 3").count() == 2 * n and kept.where("doc_id <> 3").count() == once.where("doc_id <> 3").count()
