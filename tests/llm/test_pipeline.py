"""The pipeline stage by stage against plain versions, and the registration of its queries."""

import corpus_pipeline
import __spark_entry__
from quadrille.llm import language, toxicity
from quadrille.session import stage

from .test_joins import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns = docs.columns
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF_DIR), name)
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            want = {r["doc_id"] for r in toxicity.toxicity(before, labels).where("predicted = 0").collect()}
        elif name == "language":
            want = {r["doc_id"] for r in language.language_id(before).where("lang_pred != 'und' and score >= 0.4").collect()}
        elif name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = {c for i, n, c, _ in brute(rows, 5, 80)}
            assert docs.count() == len(ids)
        else:
            want = kept["near_duplicates"]
        assert ids == want, name
        kept[name] = ids
        assert name == "packing" or docs.columns == columns
    packed = docs.toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_queries_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5
