"""Graph updates: from one state of the quads to the next. Nothing is changed in place.

The quads going in are a set, as a stored table is, and so are those coming out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, Term, as_quads, graph_is, same_row, statement_set
from ..session import stage
from .bgp import Pattern, bgp_join, is_var, match_condition
from .construct import instantiate


def load_graph(triples: DataFrame, graph: str | None) -> DataFrame:
    """What was read from a file, put in the target graph; graph names in the file do not count."""
    return statement_set(as_quads(triples, graph))


insert_model = load_graph


def graph_merge(quads: DataFrame, payload: DataFrame, graph: str | None) -> DataFrame:
    """POST: the payload is added to the graph."""
    return insert_data(quads, as_quads(payload, graph))


def graph_replace(quads: DataFrame, payload: DataFrame, graph: str | None) -> DataFrame:
    """PUT: the payload becomes the graph."""
    return quads.where(~_in(graph)).unionByName(load_graph(payload, graph))


def graph_drop(quads: DataFrame, graph: str | None, silent: bool = True) -> DataFrame:
    """DELETE: the graph is gone; ``None`` empties the default graph.

    With ``silent=False`` it is an error when a named graph is not there.
    """
    if silent or graph is None:
        return quads.where(~_in(graph))
    there = quads.where(_in(graph)).limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    absent = F.raise_error(F.lit(f"no graph {graph}")).cast("boolean")
    # The error has to ride on a row, so it is raised while the kept rows are picked.
    return quads.where(F.when(there, ~_in(graph)).otherwise(absent))


def _in(graph: str | None) -> Column:
    return F.coalesce(graph_is(graph), F.lit(False))


def insert_data(quads: DataFrame, data: DataFrame) -> DataFrame:
    """INSERT DATA: ground quads for any number of graphs at once.

    Instead of making the union a set, which would shuffle the whole table, what is inserted is taken
    out of the table first; when it is small that is a broadcast.
    """
    new = statement_set(data)
    return delete_data(quads, new).unionByName(new)


def delete_data(quads: DataFrame, doomed: DataFrame) -> DataFrame:
    """The quads that are not among the doomed; all eight columns count, NULLs too."""
    on = same_row("l", "r", QUAD_COLS)
    gone = doomed.select(*QUAD_COLS)
    return quads.alias("l").join(gone.alias("r"), on, "left_anti").select(*QUAD_COLS)


def delete_insert_where(
    quads: DataFrame,
    where: Sequence[Pattern],
    delete: Sequence[tuple] = (),
    insert: Sequence[tuple] = (),
    graph: str | Term | None = None,
) -> DataFrame:
    """WITH graph DELETE {…} INSERT {…} WHERE {…}.

    Both templates are filled from the state before the update; deletions come first, so a
    statement in both stays. Patterns and templates without a graph of their own use ``graph``.
    The changes are written first: both branches below use them, and Spark knows their size when it
    chooses how to take them out of the table.
    """
    scoped = [p if len(p) > 3 or graph is None else (*p, graph) for p in where]
    solutions = bgp_join(quads, scoped)
    parts = [
        instantiate(solutions, template, graph).withColumn("_new", F.lit(new))
        for template, new in ((delete, False), (insert, True))
        if template
    ]
    if not parts:
        return quads
    changes = stage(reduce(DataFrame.unionByName, parts), "changes")
    return delete_data(quads, changes).unionByName(changes.where("_new").select(*QUAD_COLS))


def delete_where(quads: DataFrame, pattern: Pattern) -> DataFrame:
    """DELETE {pattern} WHERE {pattern} for one pattern: a filter, no join."""
    names = [t for t in pattern if is_var(t)]
    if len(names) != len(set(names)):
        return delete_insert_where(quads, [pattern], [pattern])
    return quads.where(~F.coalesce(match_condition(pattern), F.lit(False)))
