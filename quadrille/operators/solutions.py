"""SELECT results: decoding the JSON format and mapping solutions to typed columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import as_type
from ..schema import demand

#: The SPARQL 1.1 results JSON format.
_BINDING = "map<string,struct<type:string,datatype:string,value:string,`xml:lang`:string>>"
RESULTS_SCHEMA = f"struct<head:struct<vars:array<string>>,results:struct<bindings:array<{_BINDING}>>>"


def parse_results(body: str | Column) -> Column:
    """The results document of a body, with NULL for what is missing."""
    return F.from_json(F.col(body) if isinstance(body, str) else body, RESULTS_SCHEMA)


def results_complete(doc: Column) -> Column:
    """Head, bindings and every term of the document are there."""
    whole = F.forall(
        doc["results"]["bindings"],
        lambda b: b.isNotNull()
        & F.forall(
            F.map_values(b),
            lambda t: t.isNotNull() & t["type"].isNotNull() & t["value"].isNotNull(),
        ),
    )
    return doc["head"]["vars"].isNotNull() & F.coalesce(whole, F.lit(False))


def solution_columns(binding: Column, variables: Sequence[str]) -> list[Column]:
    """Term columns per variable of one binding map; NULL where unbound."""
    out = []
    for v in variables:
        term = binding.getItem(v)
        out += [
            term["value"].alias(v),
            term["type"].alias(f"{v}_type"),
            term["datatype"].alias(f"{v}_datatype"),
            term["xml:lang"].alias(f"{v}_lang"),
        ]
    return out


def read_results_json(
    responses: DataFrame, variables: Sequence[str], body: str = "body", mode: str = "PERMISSIVE"
) -> DataFrame:
    """Solutions of results documents: other columns, ``row_no``, the variables, and ``error``.

    The caller names the variables, so the schema does not depend on the data. A body that is no
    results document (the answer to an ASK is none) gives one row with only the error.
    """
    rest = [c for c in responses.columns if c != body]
    decoded = responses.select(*rest, parse_results(body).alias("_doc"))
    good = F.coalesce(results_complete(F.col("_doc")), F.lit(False))
    error = F.lit("body is no complete results document")
    if mode == "FAILFAST":
        bindings = F.when(good, F.col("_doc.results.bindings")).otherwise(F.raise_error(error))
        rows = decoded.select(*rest, F.posexplode(bindings).alias("row_no", "_b"))
        return rows.select(*rest, "row_no", *solution_columns(F.col("_b"), variables))
    if mode == "DROPMALFORMED":
        rows = decoded.where(good).select(
            *rest, F.posexplode("_doc.results.bindings").alias("row_no", "_b")
        )
        return rows.select(*rest, "row_no", *solution_columns(F.col("_b"), variables))
    # A document without solutions has no row here; a broken one has a row with its error.
    one = F.array(F.lit(None).cast(_BINDING))
    rows = decoded.select(
        *rest,
        F.when(~good, error).alias("error"),
        F.posexplode(F.when(good, F.col("_doc.results.bindings")).otherwise(one)).alias("row_no", "_b"),
    )
    return rows.select(*rest, "row_no", *solution_columns(F.col("_b"), variables), "error")


def map_solutions(
    solutions: DataFrame, spec: Sequence[tuple[str, str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns from variables: ``spec`` lists ``(column, variable, kind)``.

    Kinds are those of :func:`quadrille.functions.terms.as_type`. An unbound variable is NULL.
    """
    return solutions.select(*keep, *[as_type(var, kind).alias(name) for name, var, kind in spec])


def map_field(solutions: DataFrame, variable: str, kind: str = "string") -> DataFrame:
    """One variable, typed, that every solution must bind; a missing or ill-typed one raises."""
    value = as_type(variable, kind)
    bound = demand(solutions, value.isNotNull(), F.lit(f"no {kind} value for {variable}"))
    return bound.select(value.alias(variable))


def map_iri_field(solutions: DataFrame, variable: str) -> DataFrame:
    return map_field(solutions, variable, "iri")


def map_string_field(solutions: DataFrame, variable: str) -> DataFrame:
    return map_field(solutions, variable, "string")


def map_delegate(solutions: DataFrame, function: Callable, schema: str) -> DataFrame:
    """A function of the caller over Arrow batches of solutions (pandas frame in, pandas frame out)."""

    def apply(batches):
        for batch in batches:
            yield function(batch)

    return solutions.mapInPandas(apply, schema)
