"""Connected components of an edge table, by contracting edges towards the smallest vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.session import stage


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a vertex below the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.where("v > u").join(_smallest_neighbour(both), "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a vertex and its smaller neighbours below the smallest of them. Edges have ``v < u``."""
    least = _smallest_neighbour(edges)
    return (
        edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u != v").distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for every vertex of an edge but the roots; ``root`` is the smallest one reachable.

    ``edges`` has two columns ``u, v`` of one orderable type; loops and repeats do not matter, an edge
    with a NULL end counts as none. The edges are written to the shared folder in each of the rounds,
    whose number grows with the logarithm of the longest path.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(edges.distinct(), "edges")
    seen = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.withColumnRenamed("v", "root")
        seen = now
