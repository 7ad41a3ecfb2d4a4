"""Bulk decoding of captured responses.

Input columns: ``request_id``, ``status`` (NULL when the transport failed), ``content_type``,
``body``, ``transport_error``. Output: the request id, ``success``, ``status``, ``error``, and the payload.
Everything but JSON-LD is decided inside the row of a response; nothing is shuffled to find out about errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import TEXT_BOOLEAN, is_results_json, media_type, parse_boolean, rdf_format_of
from ..schema import QUAD_COLS, QUAD_SCHEMA, TRIPLE_COLS, demand, statement_set
from ..sources import jsonld, turtle
from ..sources.rdf_lines import cell_quads
from .construct import dereify
from .solutions import parse_results, results_complete, solution_columns

# HTTP status codes a graph store response is judged by.
GRAPH_SUCCESS = [200, 201, 202, 204, 208]
GRAPH_FAILURE = [401, 402, 403, 404, 407, 408, 409, 410]



def status_success(status: str | Column, mode: str = "FAILFAST") -> Column:
    """Success of a graph store operation by status code. Any other code raises, or is NULL."""
    code = F.col(status) if isinstance(status, str) else status
    known = F.when(code.isin(GRAPH_SUCCESS), True).when(code.isin(GRAPH_FAILURE), False)
    if mode == "FAILFAST":
        message = F.concat(F.lit("status code outside the known ones: "), code.cast("string"))
        return known.otherwise(F.raise_error(message).cast("boolean"))
    return known


def envelope(responses: DataFrame) -> DataFrame:
    """``success`` and ``error`` from transport and status alone."""
    failed = F.col("transport_error").isNotNull()
    ok = ~failed & (F.col("status") == 200)
    return responses.select(
        "*",
        F.coalesce(ok, F.lit(False)).alias("success"),
        F.when(failed, F.lit("no response: transport failed"))
        .when(F.col("status") != 200, F.concat(F.lit("response status "), F.col("status").cast("string")))
        .alias("error"),
    )


def fold_body(chunks: DataFrame, key: str = "request_id", seq: str = "seq", chunk: str = "chunk") -> DataFrame:
    """Bodies put together from their chunks. A body is one cell, so its chunks fit one."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(seq), F.col(chunk))))
    return chunks.groupBy(key).agg(
        F.array_join(F.transform(parts, lambda c: c[chunk]), "").alias("body")
    )


def running_concat(lines: DataFrame, key: str = "request_id", seq: str = "seq", line: str = "line") -> DataFrame:
    """After each line all lines so far, the newest first; empty results are left out.

    The last result of a key holds all of its text in one cell, so a key is as small as a cell.
    """
    from pyspark.sql import Window

    so_far = (
        Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    text = F.array_join(F.reverse(F.collect_list(line).over(so_far)), "")
    return lines.select(key, seq, text.alias("text")).where(F.col("text") != "")


def stream_raw(responses: DataFrame) -> DataFrame:
    """A streamed query: bodies are handed through undecoded."""
    failed = F.col("transport_error").isNotNull()
    return responses.select(
        "request_id",
        F.coalesce(~failed & (F.col("status") == 200), F.lit(False)).alias("success"),
        "status",
        F.when(~failed, F.col("content_type")).alias("content_type"),
        F.when(~failed, F.col("body")).alias("body"),
        F.when(failed, F.lit("query not run")).alias("error"),
    )


# --- SELECT -----------------------------------------------------------------------------------


def decode_select(responses: DataFrame) -> DataFrame:
    """One row per response, with the array of ``bindings`` on success and the whole ``body`` otherwise."""
    failed = F.col("transport_error").isNotNull()
    is_json = (F.col("status") == 200) & is_results_json("content_type")
    doc = F.when(~failed & is_json, parse_results("body"))
    decoded = responses.select("request_id", "status", "content_type", "body", failed.alias("_failed"),
                               is_json.alias("_json"), doc.alias("_doc"))
    good = F.coalesce(F.col("_json") & results_complete(F.col("_doc")), F.lit(False))
    unsupported = F.concat(
        F.lit("content type is not that of results: "), F.coalesce("content_type", F.lit("none")),
    )
    error = (
        F.when(F.col("_failed"), F.lit("no response"))
        .when(good, F.lit(None).cast("string"))
        .when(F.col("_json"), F.lit("body is no complete results document"))
        .otherwise(unsupported)
    )
    return decoded.select(
        "request_id", good.alias("success"), "status", error.alias("error"),
        F.when(good, F.col("_doc.results.bindings")).alias("bindings"),
        F.when(~good, F.col("body")).alias("body"),
    )


def select_solutions(decoded: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Solutions of decoded SELECT responses, in their order within the response."""
    return decoded.where("success").select(
        "request_id", F.posexplode("bindings").alias("row_no", "_b")
    ).select("request_id", "row_no", *solution_columns(F.col("_b"), variables))


# --- UPDATE -----------------------------------------------------------------------------------


def decode_update(responses: DataFrame) -> DataFrame:
    """Only 200 is success; a text/boolean body then has the last word."""
    failed = F.col("transport_error").isNotNull()
    ok = F.coalesce(F.col("status") == 200, F.lit(False)) & ~failed
    boolean = ok & F.coalesce(media_type("content_type") == TEXT_BOOLEAN, F.lit(False))
    parsed = parse_boolean("body", strict=True)
    return responses.select(
        "request_id",
        F.when(boolean, F.coalesce(parsed, F.lit(False))).otherwise(ok).alias("success"),
        "status",
        F.when(failed, F.concat(F.lit("no response: "), F.col("transport_error")))
        .when(~ok, F.concat(F.lit("update answered with status "), F.col("status").cast("string")))
        .when(boolean & parsed.isNull(), F.lit("body is no boolean"))
        .alias("error"),
    )


def count_success(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if("success").alias("n_success")
    )


# --- CONSTRUCT --------------------------------------------------------------------------------


_QUADS = f"array<{QUAD_SCHEMA.simpleString()}>"


def _read_bodies(responses: DataFrame, wanted: Column) -> tuple[DataFrame, DataFrame]:
    """Responses with ``_format`` and ``_valid``, and the statements of all valid bodies with their ``request_id``.

    ``_format`` is NULL where ``wanted`` does not hold or no reader fits; ``_valid`` says whether the body parses as a
    whole. Lines and Turtle are parsed once, inside the row, with the prefixes and blank nodes of the response alone.
    Nodes of JSON-LD lie in each other to any depth: they are read level by level, a table each, and only the
    ids of bodies that can not be read go back to the responses.
    """
    scope = F.concat(F.col("request_id").cast("string"), F.lit("."))
    rows = responses.withColumn("_format", F.when(wanted, rdf_format_of("content_type"))).withColumn("_scope", scope)
    rows = turtle.parse_cells(
        rows.withColumn("_turtle", F.when(F.col("_format") == "TURTLE", F.col("body"))), "_turtle", F.col("_scope"), "_triples")
    in_row = (
        F.when(F.col("_format") == "NQUADS", cell_quads(F.col("body"), scope))
        .when(F.col("_format") == "NTRIPLES", cell_quads(F.col("body"), scope, quads=False))
        .when(F.col("_format") == "TURTLE", F.col("_triples"))
    )
    rows = rows.withColumn("_quads", in_row.cast(_QUADS)).drop("_turtle", "_triples")
    cells = responses.where(wanted & (rdf_format_of("content_type") == "JSONLD"))
    linked = jsonld.parse_cells(cells.select(F.col("body").alias("value"), scope.alias("_scope")))
    bad = linked.where("wrong").select("_scope", F.lit(True).alias("_bad")).distinct()
    valid = F.when(F.col("_format") == "JSONLD", F.col("_bad").isNull()).when(F.col("_format").isNotNull(), F.col("_quads").isNotNull())
    checked = rows.join(bad, "_scope", "left").withColumn("_valid", valid).drop("_scope", "_bad", "_quads")
    # An outer explode: for any other, Spark puts a condition on the array in front, and parses once more.
    own = rows.select("request_id", F.explode_outer("_quads").alias("_q")).where("_q IS NOT NULL").select("request_id", "_q.*")
    request = F.substring("_scope", F.lit(1), F.length("_scope") - 1).cast(responses.schema["request_id"].dataType)
    good = linked.join(bad, "_scope", "left_anti").select(request.alias("request_id"), *QUAD_COLS)
    return checked, own.unionByName(good)


def decode_construct(responses: DataFrame) -> DataFrame:
    """One row per response: success, status, and the error with the body that came instead."""
    failed = F.col("transport_error").isNotNull()
    ok = F.coalesce(F.col("status") == 200, F.lit(False)) & ~failed
    rows, _ = _read_bodies(responses, ok)
    parsed = F.coalesce(F.col("_valid"), F.lit(False))
    unsupported = F.concat(F.lit("unsupported Content-Type: "), F.coalesce("content_type", F.lit("none")))
    return rows.select(
        "request_id",
        (ok & parsed).alias("success"),
        F.when(failed, 0).otherwise(F.col("status")).cast("int").alias("status"),
        F.when(failed, F.col("transport_error"))
        .when(~ok, F.col("body"))
        .when(F.col("_valid").isNull(), unsupported)
        .when(~parsed, F.lit("malformed body"))
        .alias("error"),
        F.when(failed, F.lit("no response"))
        .when(~ok, F.lit("status is not 200, error holds the body"))
        .alias("message"),
    )


def construct_quads_of(responses: DataFrame) -> DataFrame:
    """The quads of successful CONSTRUCT responses: reified bodies put back together, per response.

    A node that lacks a part gives no quad; :func:`incomplete_nodes` tells of it.
    """
    ok = (F.col("status") == 200) & F.col("transport_error").isNull()
    return dereify(_read_bodies(responses, ok)[1], keep=["request_id"], on_error="DROPMALFORMED")


def incomplete_nodes(responses: DataFrame) -> DataFrame:
    """``request_id, error``: reified statements of CONSTRUCT bodies that lack a part."""
    ok = (F.col("status") == 200) & F.col("transport_error").isNull()
    nodes = dereify(_read_bodies(responses, ok)[1], keep=["request_id"], on_error="PERMISSIVE")
    message = F.concat(F.lit("incomplete reified statement: "), F.col("_corrupt_record"))
    return nodes.where(F.col("_corrupt_record").isNotNull()).select("request_id", message.alias("error"))


# --- graph store ------------------------------------------------------------------------------


def decode_graph(responses: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """One row per answered response: success by status code, and its model if it has one.

    No body, a body of an unknown type and a body with a malformed statement all mean no model, never a
    failure. Responses lost in transport have no row; with ``FAILFAST`` they raise, as do unknown codes.
    """
    return _decoded_graphs(responses, mode)[0]


def _decoded_graphs(responses: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Outcomes and the statements of all models, from one reading of the bodies."""
    lost, known = F.col("transport_error").isNotNull(), status_success("status", "PERMISSIVE")
    unknown = F.concat(F.lit("status code outside the known ones: "), F.col("status").cast("string"))
    if mode == "FAILFAST":
        answered = demand(responses, ~lost, F.concat(F.lit("transport failed: "), F.col("transport_error")))
        answered = demand(answered, known.isNotNull(), F.coalesce(unknown, F.lit("no status code")))
    else:
        answered = responses.where(~lost)
    rows, found = _read_bodies(answered, _has_body())
    decoded = rows.select(
        "request_id", known.alias("success"), "status", F.when(known.isNull(), unknown).alias("error"),
        F.coalesce("_valid", F.lit(False)).alias("has_model"),
    )
    return decoded, statement_set(found, ["request_id", *TRIPLE_COLS])


def _has_body() -> Column:
    return F.coalesce(F.length("body") > 0, F.lit(False))


def graph_models(responses: DataFrame) -> DataFrame:
    """Statements of the models of graph store responses: a set per response."""
    return _decoded_graphs(responses, "PERMISSIVE")[1]


def graph_outcomes(responses: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Decoded graph store responses with the size ``n`` of their model, NULL without one."""
    decoded, models = _decoded_graphs(responses, mode)
    sizes = models.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"))
    decoded = decoded.join(sizes, "request_id", "left")
    n = F.when(F.col("has_model"), F.coalesce("_n", F.lit(0)))
    return decoded.select("request_id", "success", "status", "error", n.cast("bigint").alias("n"))


def merge_responses(*branches: DataFrame) -> DataFrame:
    """Outcomes of all routes in one frame."""
    first, *rest = branches
    for branch in rest:
        first = first.unionByName(branch, allowMissingColumns=True)
    return first


def zip_response(envelopes: DataFrame, payloads: DataFrame) -> DataFrame:
    """Envelope and decoded body of the same request, one to one."""
    return envelopes.join(payloads, "request_id")
