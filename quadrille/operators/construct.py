"""CONSTRUCT over quads: pattern match, filter, templates, and reification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (
    OBJECT_COLS,
    QUAD_COLS,
    RDF_GRAPH,
    RDF_OBJECT,
    RDF_PREDICATE,
    RDF_SUBJECT,
    Term,
    as_term,
    demand,
    object_is,
    statement_set,
)
from ..session import stage
from .dataset import named_graphs, page, restrict
from .reasoning import rdfs_closure

Values = Sequence[str] | DataFrame | None


def construct_quads(
    quads: DataFrame,
    subjects: Values = None,
    predicates: Values = None,
    objects: Values = None,
    graphs: Values = None,
    offset: int | None = None,
    limit: int | None = None,
    is_set: bool = False,
    reasoning: bool = False,
) -> DataFrame:
    """Statements of named graphs whose subject, predicate, object and graph are in the given lists.

    An empty list does not restrict. Objects are IRIs. A page is cut before equal statements
    collapse, in the order of the quad columns. With ``is_set`` the quads are known to hold no
    statement twice, as in a stored table, and nothing has to be shuffled. With ``reasoning`` what the
    quads entail by RDFS counts as stated.
    """
    if reasoning:
        quads, is_set = rdfs_closure(quads), True
    rows = named_graphs(quads)
    rows = restrict(rows, "g", graphs)
    rows = restrict(rows, "p", predicates)
    rows = restrict(rows, "s", subjects)
    if _restricts(subjects):
        rows = rows.where(F.col("s_type") == "uri")
    rows = restrict(rows, "o", objects)
    if _restricts(objects):
        rows = rows.where(F.col("o_type") == "uri")
    return statement_set(page(rows, offset, limit), is_set=is_set)


def _restricts(values: Values) -> bool:
    return isinstance(values, DataFrame) or bool(values)


def subjects_with(quads: DataFrame, filters: dict[str, Term | str]) -> DataFrame:
    """``(g, s)`` that have, in that graph, the given value for each of the given properties.

    One scan and one combined aggregation answer any number of filters.
    """
    if not filters:
        raise ValueError("at least one filter is needed")
    conds = [(F.col("p") == p) & object_is(as_term(v)) for p, v in filters.items()]
    hits = named_graphs(quads).where(reduce(Column.__or__, conds))
    if len(conds) == 1:
        return hits.select("g", "s")
    which = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(conds)])
    counted = hits.select("g", "s", which.alias("_i")).distinct().groupBy("g", "s")
    return counted.count().where(F.col("count") == len(conds)).select("g", "s")


def filter_construct(
    quads: DataFrame,
    filters: dict[str, Term | str],
    predicates: Values = None,
    graphs: Values = None,
    offset: int | None = None,
    limit: int | None = None,
    is_set: bool = False,
    reasoning: bool = False,
) -> DataFrame:
    """All statements (of the listed predicates) of subjects that meet every filter in that graph.

    The subjects are found first and written, so that Spark knows how many they are: few are sent to
    the scan of the statements, which then stays where it is; many are joined by shuffle. With
    ``reasoning`` what the quads entail by RDFS counts as stated.
    """
    if reasoning:
        quads, is_set = stage(rdfs_closure(quads), "closure"), True
    scope = restrict(named_graphs(quads), "g", graphs)
    rows = restrict(scope, "p", predicates)
    if filters:
        subjects = stage(subjects_with(scope, filters), "subjects")
        rows = rows.join(subjects, ["g", "s"], "left_semi")
    return statement_set(page(rows.select(*QUAD_COLS), offset, limit), is_set=is_set)


# --- templates --------------------------------------------------------------------------------


def _slot(solutions: DataFrame, item: str | Term, position: str) -> tuple[Column, Column, Column, Column]:
    """Columns of one template position: a variable ``?x`` or a constant."""
    if isinstance(item, str) and item.startswith("?"):
        v = item[1:]
        return tuple(F.col(c) for c in (v, f"{v}_type", f"{v}_datatype", f"{v}_lang"))
    return tuple(as_term(item).columns()[c] for c in OBJECT_COLS)


def instantiate(
    solutions: DataFrame, template: Sequence[tuple], graph: str | Term | None = None
) -> DataFrame:
    """Quads of template triples ``(s, p, o)`` or quads ``(s, p, o, g)`` for every solution, as a set.

    Strings ``?x`` are variables, other strings are IRIs. Statements with an unbound variable, a
    literal subject or a predicate that is no IRI are skipped.
    """
    rows = []
    for item in template:
        s, p, o = (_slot(solutions, t, pos) for t, pos in zip(item, "spo"))
        named = item[3] if len(item) > 3 else graph
        g = (F.lit(None).cast("string"),) * 2 if named is None else _slot(solutions, named, "g")[:2]
        ok = (
            s[0].isNotNull() & s[1].isin("uri", "bnode") & p[0].isNotNull() & (p[1] == "uri")
            & o[0].isNotNull()
        )
        if named is not None:
            ok = ok & g[0].isNotNull() & (g[1] == "uri")
        values = [g[0], s[0], s[1], p[0], *o]
        rows.append(F.when(ok, F.struct(*[v.alias(c) for v, c in zip(values, QUAD_COLS)])))
    exploded = solutions.select(F.explode(F.array(*rows)).alias("_q")).where(F.col("_q").isNotNull())
    return statement_set(exploded.select("_q.*"))


construct_template = instantiate


# --- reification ------------------------------------------------------------------------------


def reify(quads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each quad of a named graph as four statements on a node of its own.

    The node label is a digest of the quad, so a task that runs twice makes the same node.
    """
    null = F.lit("\x1e")
    parts = [F.coalesce(F.col(c), null) for c in [*keep, *QUAD_COLS]]
    label = F.left(F.sha2(F.concat_ws("\x1f", *parts), 256), F.lit(32))
    no = F.lit(None).cast("string")
    part = lambda p, *o: F.struct(
        F.lit(p).alias("p"), *[v.alias(c) for v, c in zip(o, OBJECT_COLS)]
    )
    uri = F.lit("uri")
    parts_of = F.array(
        part(RDF_SUBJECT, F.col("s"), F.col("s_type"), no, no),
        part(RDF_PREDICATE, F.col("p"), uri, no, no),
        part(RDF_OBJECT, *[F.col(c) for c in OBJECT_COLS]),
        part(RDF_GRAPH, F.col("g"), uri, no, no),
    )
    return (
        named_graphs(quads)
        .select(*keep, label.alias("s"), F.explode(parts_of).alias("_p"))
        .select(*keep, "s", F.lit("bnode").alias("s_type"), "_p.*")
    )


def dereify(
    triples: DataFrame, keep: Sequence[str] = (), on_error: str = "FAILFAST", is_set: bool = False
) -> DataFrame:
    """Quads of groups of four statements on one node (within the ``keep`` columns), as a set.

    A node that lacks a part is an error: ``FAILFAST`` raises, ``DROPMALFORMED`` drops it, and
    ``PERMISSIVE`` returns it with the label in ``_corrupt_record``. With ``is_set`` it is known that no two nodes state
    the same quad, such as those of ``reify``, whose labels are digests of their quads; the nodes then move only once.
    """
    # Only what makes up the quad moves. Labels that are digests in hexadecimal, such as those of reify, move as their bytes.
    is_digest = F.coalesce(F.col("s").rlike("^[0-9a-f]{32}\\z"), F.lit(False))
    part = lambda iri, cols: F.max(F.when(F.col("p") == iri, F.struct(*cols)))
    nodes = triples.select(
        *keep, F.when(is_digest, F.unhex("s")).alias("_digest"), F.when(~is_digest, F.col("s")).alias("_label"), "s_type", "p", *OBJECT_COLS,
    ).groupBy(*keep, "_digest", "_label", "s_type").agg(
        part(RDF_SUBJECT, ["o", "o_type"]).alias("_s"),
        part(RDF_PREDICATE, ["o"]).alias("_p"),
        part(RDF_OBJECT, OBJECT_COLS).alias("_o"),
        part(RDF_GRAPH, ["o"]).alias("_g"),
    )
    whole = F.col("_s").isNotNull() & F.col("_p").isNotNull() & F.col("_o").isNotNull() & F.col("_g").isNotNull()
    label = F.coalesce(F.lower(F.hex("_digest")), F.col("_label"))
    columns = [
        F.col("_g.o").alias("g"),
        F.col("_s.o").alias("s"),
        F.col("_s.o_type").alias("s_type"),
        F.col("_p.o").alias("p"),
        *[F.col(f"_o.{c}").alias(c) for c in OBJECT_COLS],
    ]
    if on_error == "DROPMALFORMED":
        return statement_set(nodes.where(whole).select(*keep, *columns), [*keep, *QUAD_COLS], is_set)
    if on_error == "FAILFAST":
        message = F.concat(F.lit("incomplete reified statement: "), label)
        return statement_set(demand(nodes, whole, message).select(*keep, *columns), [*keep, *QUAD_COLS], is_set)
    marked = nodes.select(
        *keep,
        *[F.when(whole, c).alias(n) for c, n in zip(columns, QUAD_COLS)],
        F.when(~whole, label).alias("_corrupt_record"),
    )
    return marked if is_set else marked.dropDuplicates()


def dereify_positional(
    triples: DataFrame, key: Sequence[str], pos: str, block_width: int | None = None
) -> DataFrame:
    """Quads of every four statements in a row, read by place and not by predicate.

    One quad per group, duplicates kept; a short last group is an error and gives no quad. When
    ``pos`` counts lines from 0 without gaps the group is arithmetic and needs no sort.
    """
    from .scans import count_windows

    if block_width is None:
        placed = triples.withColumn("window", F.floor(F.col(pos) / 4)).withColumn("window_pos", F.col(pos) % 4)
    else:
        placed = count_windows(triples, key, pos, 4, block_width=block_width)
    part = lambda i: F.max(F.when(F.col("window_pos") == i, F.struct(*OBJECT_COLS)))
    groups = placed.groupBy(*key, "window").agg(*[part(i).alias(f"_{i}") for i in range(4)])
    return groups.where(F.col("_3").isNotNull()).select(
        *key,
        "window",
        F.col("_3.o").alias("g"),
        F.col("_0.o").alias("s"),
        F.col("_0.o_type").alias("s_type"),
        F.col("_1.o").alias("p"),
        *[F.col(f"_2.{c}").alias(c) for c in OBJECT_COLS],
    )
