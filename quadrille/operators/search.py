"""Full-text search over literals: BM25 (Robertson and Zaragoza 2009), then back to statements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, statement_set
from ..session import stage
from .construct import Values, _restricts
from .dataset import named_graphs, page, restrict
from .reasoning import rdfs_closure
from .text_index import TextIndex, impact, search_words, weight, words

DEFAULT_K = 10
#: So many hits are broadcast to the statements.
BROADCAST_HITS = 1000


def score_literals(quads: DataFrame, search: str) -> DataFrame:
    """Distinct literals of named graphs with a match: ``key`` (digest), ``value``, ``score``.

    Each task reduces a literal to its length and the counts of the few search words before anything is
    shuffled. Literals are told apart by digest; the text of those without a match never moves.
    """
    literals = named_graphs(quads).where(F.col("o_type") == "literal")
    if search.strip() == "*":
        distinct = literals.select("o").distinct()
        return distinct.select(F.sha2("o", 256).alias("key"), F.col("o").alias("value"), F.lit(1.0).alias("score"))
    terms = search_words(search)
    # Words are cut once, then counted.
    cut = literals.select("o", words("o").alias("_w"))
    tf = [_occurrences("_w", t).alias(f"_tf{i}") for i, t in enumerate(terms)]
    counted = cut.select("o", F.size("_w").alias("_len"), *tf)
    names = [f"_tf{i}" for i in range(len(terms))]
    hit = reduce(Column.__or__, [F.col(n) > 0 for n in names])
    # The reduced literals are small next to the texts and needed twice, so they are written: the
    # texts are scanned and cut once.
    docs = stage(
        counted.select(
            F.sha2("o", 256).alias("key"), F.when(hit, F.col("o")).alias("value"), "_len", *names
        ).distinct(),
        "literals",
    )
    stats = docs.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("_len").alias("avg"),
            *[F.count_if(F.col(n) > 0).alias(f"df{i}") for i, n in enumerate(names)],
        )
    ).scalar()
    scored = docs.where(hit).withColumn("_s", stats)
    n, avg = F.col("_s.n"), F.col("_s.avg")
    parts = []
    for i, name in enumerate(names):
        df, tf_i = F.col(f"_s.df{i}"), F.col(name)
        parts.append(weight(n, df) * impact(tf_i, F.col("_len"), avg))
    return scored.select("key", "value", reduce(Column.__add__, parts).alias("score"))


def _occurrences(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def topk_text(quads: DataFrame, search: str, k: int = DEFAULT_K, index: TextIndex | None = None) -> DataFrame:
    """The ``k`` best literals, ties by text. With an ``index`` of the quads only what it holds of the words is read."""
    if index is not None and search.strip() != "*":
        return index.top(search, k)
    scored = score_literals(quads, search)
    return scored.orderBy(F.round("score", 9).desc(), "value").limit(k)


def search_construct(
    quads: DataFrame,
    search: str = "*",
    subjects: Values = None,
    predicates: Values = None,
    graphs: Values = None,
    offset: int | None = None,
    limit: int | None = None,
    is_set: bool = False,
    reasoning: bool = False,
    index: TextIndex | None = None,
) -> DataFrame:
    """Statements whose literal is among the best matches; scores are not part of the result.

    The limit bounds the matches (10 without one) and then the statements as well. An ``index`` is that of the
    quads as they are given, so it does not go with ``reasoning``.
    """
    if reasoning:
        if index is not None:
            raise ValueError("the index does not know what is entailed")
        quads, is_set = stage(rdfs_closure(quads), "closure"), True
    k = limit if limit is not None else DEFAULT_K
    hits = topk_text(quads, search, k, index).select(F.col("value").alias("o"))
    rows = named_graphs(quads).where(F.col("o_type") == "literal")
    rows = restrict(rows, "g", graphs)
    rows = restrict(rows, "p", predicates)
    rows = restrict(rows, "s", subjects)
    if _restricts(subjects):
        rows = rows.where(F.col("s_type") == "uri")
    # A few hits go to the statements; of many, both sides are dealt.
    found = rows.join(F.broadcast(hits) if k <= BROADCAST_HITS else hits, "o", "left_semi").select(*QUAD_COLS)
    return statement_set(page(found, offset, limit), is_set=is_set)
