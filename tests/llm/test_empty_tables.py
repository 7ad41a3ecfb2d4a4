"""Stages and operators on empty tables, NULL and empty texts, repeated rows and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quadrille.llm import fingerprints, language, ngram_join, pieces, toxicity

from .test_documents import MODEL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_stages_of_nothing(spark, given):
    for name, function in corpus_pipeline.STAGES:
        found = function(spark, given.limit(0), SF_DIR)
        assert found.collect() == [] and (name == "packing" or found.columns == given.columns), name


def test_operators_of_nothing(spark, given):
    none = given.limit(0)
    assert fingerprints.near_duplicates(none).collect() == []
    assert ngram_join.keep_one_per_group(none).collect() == []
    coded = spark.createDataFrame([], "doc_id long, ids array<int>")
    assert pieces.decode(coded, MODEL).collect() == []
    assert [r["decoded"] for r in pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), MODEL).collect()] == ["", ""]


def test_filters_keep_repeated_rows_and_all_columns(spark, given):
    some = given.where(F.col("text").isNotNull()).orderBy("doc_id").limit(60)
    odd = spark.createDataFrame([(100_001, None), (100_002, ""), (None, "12 34 ..")], "doc_id long, text string")
    docs = some.unionByName(odd, allowMissingColumns=True)
    docs = docs.unionByName(docs).withColumn("score", F.lit("x")).withColumn("row", F.lit(1)).withColumn("features", F.lit(2))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for kept in (toxicity.keep_civil(docs, labels), language.keep_languages(docs)):
        found = kept.collect()
        assert kept.columns == docs.columns and len(found) % 2 == 0 and len(set(found)) == len(found) // 2
        assert set(found) <= set(docs.collect())
    assert not {100_001, 100_002, None} & {r["doc_id"] for r in language.keep_languages(docs).collect()}


def test_near_duplicates_without_words(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two three four five six"), (4, "one two three four five six"), (7, "One two three four five six")]
    found = fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("band", F.lit(1))).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (7, 2, 4)]
