"""The stored text index against a search that reads every literal."""

import random

import pytest
from pyspark.sql import functions as F

from quadrille.operators import search, text_index

from .data import frame, text


@pytest.fixture(scope="module")
def quads(spark):
    rng = random.Random(5)
    common, rare = ["the", "of", "red", "fox"], [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        n = rng.randint(1, 40)
        said = rng.choices(common, k=n // 2) + rng.choices(rare, k=n - n // 2)
        rows.append(text("urn:g", f"urn:s{i}", "urn:p", " ".join(said)))
    rows += [text("urn:g", "urn:x", "urn:p", "Red, FOX!"), text("urn:h", "urn:y", "urn:p", "red fox"), text("urn:h", "urn:z", "urn:p", "red fox"),
             text("urn:g", "urn:e", "urn:p", ""), text(None, "urn:out", "urn:p", "red fox red fox")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def index(spark, quads, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    text_index.write_index(quads, path, block=8)
    return text_index.TextIndex(spark, path)


def rounded(df):
    return [(r["value"], round(r["score"], 9)) for r in df.collect()]


@pytest.mark.parametrize("words, k", [("red fox", 10), ("word7", 5), ("the word1 word2 word3", 25), ("fox", 1), ("the of", 600), ("word9 absent", 3)])
def test_the_same_as_reading_all(quads, index, words, k):
    assert rounded(search.topk_text(quads, words, k, index=index)) == rounded(search.topk_text(quads, words, k))


def test_blocks_that_can_not_hold_the_best_are_not_read(index):
    weights = index._weights(["word7", "red"])
    few, all_ = index.candidate_blocks(weights, 1).count(), index.candidate_blocks(weights, 10_000).count()
    assert 0 < few < all_ / 2
    # Whatever is left out scores less than the best.
    assert index.scores("word7 red", 1).count() < index.scores("word7 red", 10_000).count()


def test_a_search_scans_its_words_alone(index):
    plan = index.scores("word7", 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(word,word7)" in plan or "In(word, [word7])" in plan


def test_words_that_are_nowhere(quads, index):
    assert index.top("nowhere", 5).collect() == []
    with pytest.raises(ValueError):
        index.top("?!", 5)


def test_statements_of_the_hits(quads, index):
    plain = search.search_construct(quads, "red fox", limit=2)
    assert sorted(map(str, search.search_construct(quads, "red fox", limit=2, index=index).collect())) == sorted(map(str, plain.collect()))
    found = search.search_construct(quads, "red fox", index=index, graphs=["urn:h"], limit=500)
    assert {r["s"] for r in found.collect()} == {"urn:y", "urn:z"}
    assert search.search_construct(quads, "*", limit=3, index=index).count() == 3
    with pytest.raises(ValueError):
        search.search_construct(quads, "red", reasoning=True, index=index)


def test_an_index_of_nothing(spark, quads, tmp_path):
    text_index.write_index(quads.limit(0), str(tmp_path / "none"))
    assert text_index.TextIndex(spark, str(tmp_path / "none")).top("red", 3).collect() == []


def test_postings_hold_numbers_and_true_counts(spark, quads, index):
    """Digests in postings took several times the disk of the texts."""
    postings = index.table("postings")
    assert dict(postings.dtypes)["key"] == "bigint"
    texts = index.table("texts")
    assert texts.count() == texts.select("key").distinct().count() == texts.select("value").distinct().count()
    words = texts.select("key", F.explode(text_index.words("value")).alias("word")).groupBy("word", "key").agg(F.count("*").alias("tf"))
    assert {tuple(r) for r in postings.select("word", "key", "tf").collect()} == {tuple(r) for r in words.collect()}
    assert postings.where("block != key div 8").count() == 0
