"""A stored inverted index over literals, and top-k search on it by BM25 with block maxima.

Distinct literals are numbered as they are written, and a block is a run of numbers. The index holds

* ``postings``: ``word, block, key, tf, len``, clustered by word and block, so that a search reads the row groups
  of its words and blocks alone;
* ``blocks``: per word and block the largest ``impact`` that one of its literals has, without the weight of the word;
* ``words``: in how many literals a word stands; ``stats``: how many literals there are, and their mean length;
* ``texts``: the literals with their numbers (``key``) and lengths.

A literal of a block scores at most the sum of the block's maxima, and in every block one literal scores at least the
largest of them. So the k-th largest of the latter is a score that the k best reach, and blocks whose sum is below
are never read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .dataset import named_graphs

K1, B = 1.2, 0.75
WORD = "[\\p{L}\\p{N}_]+"
#: Literals of one block, about.
BLOCK = 256
#: What rounding may add to or take from a score.
SLACK = 1e-6


def words(text: str | Column) -> Column:
    """Lower-case words of a text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def search_words(search: str) -> list[str]:
    """The distinct words of a search."""
    found = sorted(set(re.findall(r"\w+", search.lower())))
    if not found:
        raise ValueError("the search has no word")
    return found


def weight(n: Column, df: Column) -> Column:
    """How much a word counts that stands in ``df`` of ``n`` literals."""
    return F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def impact(tf: Column, length: Column, avg: Column) -> Column:
    """What ``tf`` occurrences in a literal of a length give, before the weight of the word."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avg))


def _counts(found: Column) -> Column:
    """``word, tf`` of each distinct word of an array: sorted, equal words stand together."""
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def runs(w: Column) -> Column:
        places = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(w, i).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(w)) - i).alias("tf"))))

    return let(F.array_sort(found), runs)


def write_index(quads: DataFrame, path: str, block: int = BLOCK) -> None:
    """Index the literals of all named graphs under a path. Each distinct literal counts once.

    Words are counted within their literal, so postings move once, and hold a number and no digest: digests do not
    compress. A word that stands in most literals is spread over its blocks. The index is that of one state of the quads:
    it is written anew for another.
    """
    spark = quads.sparkSession
    literals = named_graphs(quads).where(F.col("o_type") == "literal").select(F.col("o").alias("value")).distinct()
    # Numbers depend on the order of the rows, so they are read from what was written, never computed again.
    literals.select(F.monotonically_increasing_id().alias("key"), "value", F.size(words("value")).alias("len")).write.parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")
    texts.agg(F.count("*").alias("n"), F.avg("len").alias("avg")).write.parquet(f"{path}/stats")
    avg = spark.read.parquet(f"{path}/stats").first()["avg"]
    counted = texts.select("key", "len", F.explode(_counts(words("value"))).alias("_c"))
    (
        counted.select("_c.word", F.expr(f"key div {block}").alias("block"), "key", "_c.tf", "len")
        .repartitionByRange("word", "block").sortWithinPartitions("word", "block", "key").write.parquet(f"{path}/postings")
    )
    postings = spark.read.parquet(f"{path}/postings")
    per_block = postings.groupBy("word", "block").agg(
        F.max(impact(F.col("tf"), F.col("len"), F.lit(avg or 1.0))).alias("impact"), F.count("*").alias("n"))
    per_block.repartitionByRange("word", "block").sortWithinPartitions("word", "block").write.parquet(f"{path}/blocks")
    per_word = spark.read.parquet(f"{path}/blocks").groupBy("word").agg(F.sum("n").alias("df"))
    per_word.repartitionByRange("word").sortWithinPartitions("word").write.parquet(f"{path}/words")


class TextIndex:
    """A stored index. What a search brings to the driver is a row per word of the search."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _weights(self, terms: list[str]) -> dict[str, float]:
        n = F.lit(self.table("stats").first()["n"])
        found = self.table("words").where(F.col("word").isin(terms)).select("word", weight(n, F.col("df")).alias("w"))
        return {r["word"]: r["w"] for r in found.collect()}

    def candidate_blocks(self, weights: dict[str, float], k: int) -> DataFrame:
        """``block`` of those that may hold one of the ``k`` best."""
        most = self._weighted(weights) * F.col("impact")
        bounds = stage(self.table("blocks").where(F.col("word").isin(list(weights))).groupBy("block").agg(
            F.sum(most).alias("most"), F.max(most).alias("least")), "search-blocks")
        reached = bounds.orderBy(F.desc("least")).limit(k).agg(
            F.when(F.count("*") == k, F.min("least")).otherwise(F.lit(0.0)).alias("reached")).scalar()
        return bounds.where(F.col("most") >= reached - SLACK).select("block")

    @staticmethod
    def _weighted(weights: dict[str, float]) -> Column:
        return reduce(lambda c, kv: F.when(F.col("word") == kv[0], F.lit(kv[1])).otherwise(c), weights.items(), F.lit(0.0))

    def scores(self, search: str, k: int) -> DataFrame:
        """``key, score`` of all literals with a word of the search in the blocks that may hold one of the ``k`` best."""
        weights = self._weights(search_words(search))
        if not weights:
            return self.table("texts").select("key", F.lit(0.0).alias("score")).limit(0)
        avg = self.table("stats").first()["avg"]
        postings = self.table("postings").where(F.col("word").isin(list(weights)))
        postings = postings.join(self.candidate_blocks(weights, k), "block", "left_semi")
        part = self._weighted(weights) * impact(F.col("tf"), F.col("len"), F.lit(avg))
        # The parts are added in order of the words, so that equal scores are equal.
        parts = F.array_sort(F.collect_list(F.struct("word", part.alias("part"))))
        return postings.groupBy("key").agg(parts.alias("_p")).select(
            "key", F.aggregate("_p", F.lit(0.0), lambda s, p: s + p["part"]).alias("score"))

    def top(self, search: str, k: int) -> DataFrame:
        """``key, value, score`` of the ``k`` best literals, ties by text."""
        scored = stage(self.scores(search, k).withColumn("_s", F.round("score", 9)), "search-scores")
        reached = scored.orderBy(F.desc("_s")).limit(k).agg(F.min("_s")).scalar()
        best = scored.where(F.col("_s") >= reached).join(self.table("texts"), "key")
        return best.orderBy(F.desc("_s"), "value").limit(k).select(F.sha2("value", 256).alias("key"), "value", "score")
