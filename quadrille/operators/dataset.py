"""Which graphs are seen, which statements are kept, and pages of results."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import QUAD_ORDER, TRIPLE_COLS, Term, as_quads, as_term, graph_is, object_is, statement_set
from ..session import stage


def named_graphs(quads: DataFrame) -> DataFrame:
    """``GRAPH ?g { … }``: named graphs only."""
    return quads.where(F.col("g").isNotNull())


def default_graph(quads: DataFrame) -> DataFrame:
    """Statements outside any named graph."""
    return quads.where(F.col("g").isNull())


def dataset_clause(
    quads: DataFrame, default_graphs: Sequence[str] = (), named: Sequence[str] = (), is_set: bool = False
) -> DataFrame:
    """The dataset of FROM and FROM NAMED. Without either, all there is.

    The default graph becomes the merge, as a set, of the listed graphs; it is empty when only
    named graphs are listed.
    """
    if not default_graphs and not named:
        return quads
    parts = []
    if default_graphs:
        merged = as_quads(quads.where(F.col("g").isin(list(default_graphs))), None)
        parts.append(statement_set(merged, is_set=is_set and len(set(default_graphs)) == 1))
    if named:
        parts.append(quads.where(F.col("g").isin(list(named))))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def restrict(df: DataFrame, column: str, values: Sequence[str] | DataFrame | None) -> DataFrame:
    """``VALUES ?column { … }``: keep rows whose column is listed; no list, no restriction.

    A sequence is a filter that Parquet statistics can serve. A one-column frame is a semi join whose
    strategy Spark picks from the measured size; use it for long lists.
    """
    if values is None:
        return df
    if not isinstance(values, DataFrame):
        values = list(dict.fromkeys(values))
        if not values:
            return df
        return df.where(F.col(column).isin(values))
    keys = values.toDF(column)
    return df.join(keys, column, "left_semi").select(*df.columns)


def prebind(solutions: DataFrame, bindings: dict[str, Term | str] | DataFrame) -> DataFrame:
    """``$name=term``: keep solutions where the named variables have the given terms.

    Solutions have columns ``x``, ``x_type``, ``x_datatype``, ``x_lang`` per variable. A frame with
    the same columns for some variables holds many bindings at once; rows match any of them.
    """
    if isinstance(bindings, DataFrame):
        keys = bindings.dropDuplicates()
        on = None
        left, right = solutions.alias("l"), keys.alias("r")
        for c in keys.columns:
            eq = F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
            on = eq if on is None else on & eq
        return left.join(right, on, "left_semi")
    for name, value in bindings.items():
        if not re.fullmatch("[A-Za-z0-9_.~-]+", name):
            raise ValueError(f"the name {name!r} can not stand in a URL")
        solutions = solutions.where(variable_is(name, as_term(value)))
    return solutions


def variable_is(name: str, term: Term) -> Column:
    if term.type == "bnode":
        raise ValueError("a blank node can not be used as a binding")
    cond = (F.col(name) == term.value) & (F.col(f"{name}_type") == term.type)
    if term.type == "literal":
        cond = cond & (F.col(f"{name}_datatype") == term.datatype)
        cond = cond & F.col(f"{name}_lang").eqNullSafe(F.lit(term.lang).cast("string"))
    return cond


def select_vars(solutions: DataFrame, variables: Sequence[str]) -> DataFrame:
    """SELECT: the listed variables with the columns of their terms. Solutions stay a bag."""
    return solutions.select(
        *[c for v in variables for c in (v, f"{v}_type", f"{v}_datatype", f"{v}_lang")]
    )


def has_value(variable: str) -> Column:
    """The variable is bound."""
    return F.col(variable).isNotNull()


#: Pages that end within so many rows are kept in the memory of each task.
TOP_ROWS = 1 << 14


def page(
    df: DataFrame,
    offset: int | None = None,
    limit: int | None = None,
    order: Sequence[str] = tuple(QUAD_ORDER),
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the given total order, NULL first; they come out unordered.

    A page that ends within ``TOP_ROWS`` rows is picked by a top-k: each task keeps as many rows, and nothing is sorted
    or written. Others are sorted over the cluster, numbered by the sizes of the partitions before them, and
    cut, so no page piles up in one task however deep or wide it is; before the exchange every task drops
    what lies behind the end of the page.
    """
    if offset is None and limit is None:
        return df
    skip = offset or 0
    if limit is not None and skip + limit <= TOP_ROWS:
        return df.orderBy(*(F.col(c).asc_nulls_first() for c in order)).offset(skip).limit(limit)
    # The last key parts equal rows of a bag, which any place among each other suits.
    keys = [*(F.col(c).asc_nulls_first() for c in order), F.monotonically_increasing_id()]
    placed = df.withColumn("_place", keys.pop())
    keys = [*keys, F.col("_place")]
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    if limit is not None:
        placed = placed.sortWithinPartitions(*keys).withColumn("_row", in_task).where(F.col("_row") < skip + limit).drop("_row")
    numbered = stage(
        placed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_place")
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            in_task.alias("_row"),
        ),
        "page",
    )
    # One row per partition of the sort, whatever the size of the data.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    at = F.col("_before") + F.col("_row")
    wanted = at >= skip if limit is None else (at >= skip) & (at < skip + limit)
    starts = sizes.select("_part", before.alias("_before"))
    return numbered.join(starts, "_part").where(wanted).select(*df.columns)


def top(df: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    """LIMIT in a stated order."""
    return page(df, None, limit, order)


def get_graph(quads: DataFrame, graph: str | None) -> DataFrame:
    """The content of one graph, as triples."""
    return quads.where(graph_is(graph)).select(*TRIPLE_COLS)


def graph_size(quads: DataFrame) -> DataFrame:
    """Statements per graph."""
    return quads.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


def contexts(quads: DataFrame) -> DataFrame:
    """Graphs that hold a statement."""
    return quads.select("g").distinct()


def predicates(quads: DataFrame) -> DataFrame:
    """Predicates in use."""
    return quads.select("p").distinct()


def matching(
    s: str | None = None, p: str | None = None, o: Term | str | None = None
) -> Column:
    """A triple pattern with ground terms only; ``None`` matches anything."""
    cond = F.lit(True)
    if s is not None:
        cond = cond & (F.col("s") == s) & (F.col("s_type") == "uri")
    if p is not None:
        cond = cond & (F.col("p") == p)
    if o is not None:
        cond = cond & object_is(as_term(o))
    return cond


