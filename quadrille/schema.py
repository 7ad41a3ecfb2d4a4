"""The quad table: its columns, RDF terms and the identity of a statement."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# W3C namespaces.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"

RDF_TYPE = RDF + "type"
RDF_LANGSTRING = RDF + "langString"
XSD_STRING = XSD + "string"

#: Reification predicates. ``rdf:graph`` is not a W3C term; it carries the graph of the statement.
RDF_SUBJECT = RDF + "subject"
RDF_PREDICATE = RDF + "predicate"
RDF_OBJECT = RDF + "object"
RDF_GRAPH = RDF + "graph"

#: Columns of a triple (no graph) and of a quad. ``g`` NULL is the default graph.
TRIPLE_COLS = ["s", "s_type", "p", "o", "o_type", "o_datatype", "o_lang"]
QUAD_COLS = ["g", *TRIPLE_COLS]
#: The part of a statement that is the object term.
OBJECT_COLS = ["o", "o_type", "o_datatype", "o_lang"]

QUAD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in QUAD_COLS])

#: The total order used wherever the result depends on order (paging): nulls first, then binary.
QUAD_ORDER = QUAD_COLS


@dataclass(frozen=True)
class Term:
    """An RDF term. ``type`` uses the names of the SPARQL results JSON format."""

    value: str
    type: str = "uri"
    datatype: str | None = None
    lang: str | None = None

    def columns(self) -> dict[str, Column]:
        """The term as literal columns, named as object columns."""
        values = (self.value, self.type, self.datatype, self.lang)
        return {c: F.lit(v).cast("string") for c, v in zip(OBJECT_COLS, values)}


def iri(value: str) -> Term:
    return Term(value)


def literal(value: str, datatype: str | None = None, lang: str | None = None) -> Term:
    if lang is not None:
        return Term(value, "literal", RDF_LANGSTRING, lang)
    return Term(value, "literal", datatype or XSD_STRING)


def as_term(value: str | Term) -> Term:
    """Plain strings stand for IRIs."""
    return value if isinstance(value, Term) else iri(value)


def object_is(term: Term) -> Column:
    """Term equality on the object columns: lexical form, kind, datatype and language."""
    if term.type == "bnode":
        raise ValueError("a blank node can not be used as a query constant")
    cond = (F.col("o") == term.value) & (F.col("o_type") == term.type)
    if term.type == "literal":
        cond = cond & (F.col("o_datatype") == term.datatype)
        cond = cond & (F.col("o_lang") == term.lang if term.lang else F.col("o_lang").isNull())
    return cond


def graph_is(graph: str | None) -> Column:
    """The graph equals the given name; ``None`` is the default graph."""
    return F.col("g").isNull() if graph is None else F.col("g") == graph


def as_quads(triples: DataFrame, graph: str | None | Column) -> DataFrame:
    """Put triples in one graph, whatever graph they carried before."""
    g = graph if isinstance(graph, Column) else F.lit(graph)
    return triples.select(g.cast("string").alias("g"), *TRIPLE_COLS)


def statement_set(
    df: DataFrame, cols: Sequence[str] = tuple(QUAD_COLS), is_set: bool = False
) -> DataFrame:
    """RDF models are sets: collapse equal statements, unless it is known that there are none.

    Copies are combined before the shuffle, so a statement on a third of the rows is no burden. The
    shuffle is by the statement as one value: by its columns, Spark would leave rows where a join by
    subject put them, and a subject with most of the rows could not be split any more.
    """
    rows = df.select(*cols)
    if is_set:
        return rows
    whole = rows.select(F.struct(*cols).alias("_q"))
    return whole.groupBy("_q").agg(F.lit(1).alias("_one")).select("_q.*")


def demand(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """All rows of a frame, or an error if one is not ``ok``.

    The check is a filter: no plan leaves a filter out, whatever columns are wanted afterwards.
    """
    return df.where(F.when(ok, True).otherwise(F.raise_error(message).cast("boolean")))


def same_row(left: str, right: str, cols: Iterable[str]) -> Column:
    """NULL-safe equality of the named columns of two aliased frames."""
    cond = None
    for c in cols:
        eq = F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        cond = eq if cond is None else cond & eq
    return cond
