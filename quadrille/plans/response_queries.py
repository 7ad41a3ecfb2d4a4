"""Queries over captured responses and over solutions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import terms
from ..operators import bgp, responses, solutions
from ..schema import RDF_LANGSTRING, XSD
from ..sources import rdf_lines, writers
from . import views as V
from .registry import query

R = f"WITH responses AS ({V.RESPONSES_SQL}) "
_MEDIA = "lower(trim(split_part(content_type, ';', 1)))"
_KEY = "'urn:orders:' || CAST(o_orderkey AS VARCHAR)"
_CUST = "'urn:customer:' || CAST(o_custkey AS VARCHAR)"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_CUSTOMER = "'urn:customer:' || CAST(c_custkey AS VARCHAR)"
_NATION = "'urn:nation:' || CAST(c_nationkey AS VARCHAR)"
_QUERY = "o_totalprice >= 100000 AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus IN ('O', 'F')"
VARS = ["order", "customer", "total"]

# The solutions that the results documents hold, straight from the orders.
_SOLUTIONS = (
    f"SELECT o_orderkey AS request_id, 0 AS row_no, {_KEY} AS \"order\", "
    f"CASE WHEN o_orderstatus = 'O' THEN {_CUST} END AS customer, "
    f"CASE WHEN o_orderstatus = 'O' THEN {_PRICE} END AS total, "
    f"CASE WHEN o_orderstatus = 'O' THEN '{XSD}decimal' END AS total_datatype FROM orders WHERE {_QUERY} "
    f"UNION ALL SELECT o_orderkey, 1, {_KEY}, NULL, {_PRICE}, '{XSD}decimal' FROM orders WHERE {_QUERY} "
    "AND o_orderstatus = 'O'"
)
SOLUTION_COLUMNS = ["request_id", "row_no", "order", "customer", "total", "total_datatype"]


def _answered(spark, sf_dir):
    """Bodies of answered queries of the right type, good or broken."""
    return V.responses(spark, sf_dir, "query").where(
        (F.col("status") == 200) & terms.is_results_json("content_type")
    )


def _solutions(spark, sf_dir):
    decoded = responses.decode_select(V.responses(spark, sf_dir, "query"))
    return responses.select_solutions(decoded, VARS)


# --- decoding ---------------------------------------------------------------------------------


@query(
    "read_results_json",
    _SOLUTIONS.replace(" FROM orders", ", CAST(NULL AS VARCHAR) AS error FROM orders", 1).replace(
        f"'{XSD}decimal' FROM orders WHERE {_QUERY} AND", f"'{XSD}decimal', NULL FROM orders WHERE {_QUERY} AND"
    )
    + " UNION ALL SELECT request_id, 0, NULL, NULL, NULL, NULL, 'body is no complete results document' "
    f"FROM ({V.RESPONSES_SQL}) WHERE route = 'query' AND body LIKE '%boolean%'",
)
def read_results_json(spark, sf_dir):
    rows = solutions.read_results_json(_answered(spark, sf_dir).select("request_id", "body"), VARS)
    return rows.select(*SOLUTION_COLUMNS, "error")


@query(
    "decode_boolean",
    R + "SELECT request_id, CASE WHEN lower(body) IN ('true', 'false') THEN lower(body) = 'true' END AS strict, "
    "coalesce(lower(body) = 'true', false) AS lenient FROM responses WHERE route = 'update'",
)
def decode_boolean(spark, sf_dir):
    return V.responses(spark, sf_dir, "update").select(
        "request_id", terms.parse_boolean("body").alias("strict"),
        terms.parse_boolean("body", strict=False).alias("lenient"),
    )


_FORMAT = (
    f"CASE {_MEDIA} WHEN 'application/n-triples' THEN 'NTRIPLES' WHEN 'application/n-quads' THEN 'NQUADS' "
    "WHEN 'text/x-nquads' THEN 'NQUADS' WHEN 'application/octet-stream' THEN 'NTRIPLES' WHEN 'text/turtle' THEN 'TURTLE' "
    "WHEN 'application/ld+json' THEN 'JSONLD' END"
)


@query(
    "rdf_format_of",
    R + f", f AS (SELECT content_type, {_FORMAT} AS rdf_format FROM responses) SELECT content_type, rdf_format, "
    "CASE rdf_format WHEN 'NTRIPLES' THEN 'application/n-triples' WHEN 'NQUADS' THEN 'application/n-quads' "
    "WHEN 'TURTLE' THEN 'text/turtle' WHEN 'JSONLD' THEN 'application/ld+json' END AS sent_as, count(*) AS n FROM f GROUP BY ALL",
)
def rdf_format_of(spark, sf_dir):
    named = V.responses(spark, sf_dir).select(
        "content_type", terms.rdf_format_of("content_type").alias("rdf_format")
    )
    return named.groupBy("content_type", "rdf_format", terms.content_type_of("rdf_format").alias("sent_as")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "is_results_json",
    R + f"SELECT coalesce({_MEDIA} = 'application/sparql-results+json', false) AS yes, count(*) AS n "
    "FROM responses GROUP BY ALL",
)
def is_results_json(spark, sf_dir):
    return V.responses(spark, sf_dir).groupBy(terms.is_results_json("content_type").alias("yes")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "frame_lines",
    "WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS f FROM documents), "
    "kept AS (SELECT doc_id, CASE WHEN f[-1] = '' THEN f[:-2] ELSE f END AS f FROM cut), "
    "rows AS (SELECT doc_id, unnest(range(len(f))) AS i, f FROM kept) "
    "SELECT doc_id, CAST(i AS INTEGER) AS frame_no, f[i + 1] AS frame, "
    "CASE WHEN length(f[i + 1]) > 1024 THEN 'frame longer than 1024 characters' END AS frame_error FROM rows",
)
def frame_lines(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return rdf_lines.frame_lines(docs, "text", max_length=1024)


@query(
    "fold_body",
    R + "SELECT request_id, body FROM responses WHERE length(body) > 0",
)
def fold_body(spark, sf_dir):
    return responses.fold_body(V.chunks(spark, sf_dir))


@query(
    "running_concat",
    "SELECT conv_id, turn, (SELECT string_agg(b.text, '' ORDER BY b.turn DESC) FROM conversations b "
    "WHERE b.conv_id = a.conv_id AND b.turn <= a.turn) AS text FROM conversations a",
)
def running_concat(spark, sf_dir):
    turns = V.table(spark, sf_dir, "conversations")
    return responses.running_concat(turns, key="conv_id", seq="turn", line="text")


@query(
    "status_filter",
    R + "SELECT status, CASE WHEN status IN (200, 201, 202, 204, 208) THEN true "
    "WHEN status IN (401, 402, 403, 404, 407, 408, 409, 410) THEN false END AS success, count(*) AS n "
    "FROM responses WHERE transport_error IS NULL GROUP BY ALL",
)
def status_filter(spark, sf_dir):
    rows = V.responses(spark, sf_dir).where(F.col("transport_error").isNull())
    return rows.groupBy("status", responses.status_success("status", "PERMISSIVE").alias("success")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "decode_select",
    R + ", d AS (SELECT *, status = 200 AND "
    f"coalesce({_MEDIA} = 'application/sparql-results+json', false) AS is_json, body LIKE '%bindings%' AS good "
    "FROM responses WHERE route = 'query') "
    "SELECT request_id, coalesce(is_json AND good, false) AS success, status, "
    "CASE WHEN transport_error IS NOT NULL THEN 'no response' WHEN is_json AND good THEN NULL "
    "WHEN is_json THEN 'body is no complete results document' ELSE 'content type is not that of results: ' || coalesce(content_type, 'none') "
    "END AS error, CASE WHEN NOT coalesce(is_json AND good, false) THEN body END AS body, "
    "CASE WHEN is_json AND good THEN CASE WHEN content_type LIKE '%UTF-8' THEN 1 ELSE 2 END END AS n FROM d",
)
def decode_select(spark, sf_dir):
    decoded = responses.decode_select(V.responses(spark, sf_dir, "query"))
    return decoded.select("request_id", "success", "status", "error", "body", F.when(F.col("success"), F.size("bindings")).alias("n"))


@query(
    "decode_update",
    R + "SELECT request_id, CASE WHEN status IS DISTINCT FROM 200 THEN false "
    f"WHEN {_MEDIA} = 'text/boolean' THEN lower(body) = 'true' ELSE true END AS success, status, "
    "CASE WHEN transport_error IS NOT NULL THEN 'no response: ' || transport_error "
    "WHEN status <> 200 THEN 'update answered with status ' || CAST(status AS VARCHAR) "
    f"WHEN {_MEDIA} = 'text/boolean' AND lower(body) NOT IN ('true', 'false') THEN 'body is no boolean' "
    "END AS error FROM responses WHERE route = 'update'",
)
def decode_update(spark, sf_dir):
    return responses.decode_update(V.responses(spark, sf_dir, "update"))


@query(
    "count_success",
    R + "SELECT count(*) AS n_requests, count(*) FILTER (status = 200 AND "
    f"({_MEDIA} <> 'text/boolean' OR lower(body) = 'true')) AS n_success FROM responses WHERE route = 'update'",
)
def count_success(spark, sf_dir):
    return responses.count_success(responses.decode_update(V.responses(spark, sf_dir, "update")))


_CONSTRUCTED = (
    "SELECT o_orderkey AS request_id, 'urn:g:orders' AS g, "
    f"{_KEY} AS s, 'uri' AS s_type, 'urn:p:o_custkey' AS p, {_CUST} AS o, 'uri' AS o_type, "
    "CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang FROM orders WHERE o_orderpriority = '3-MEDIUM' "
    "AND o_totalprice >= 100000 AND (o_orderstatus <> 'P' OR o_totalprice < 250000) UNION ALL "
    f"SELECT o_orderkey, 'urn:g:orders', {_KEY}, 'uri', 'urn:p:o_totalprice', {_PRICE}, 'literal', '{XSD}decimal', NULL "
    "FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_totalprice >= 100000 AND o_orderstatus = 'F' UNION ALL "
    f"SELECT -1 - c_custkey, 'urn:g:customer', {_CUSTOMER}, 'uri', 'urn:p:c_name', {V.LONG_TEXT}, 'literal', '{XSD}string', NULL "
    "FROM customer WHERE c_custkey % 8 = 0 UNION ALL "
    f"SELECT -1 - c_custkey, 'urn:g:customer', {_CUSTOMER}, 'uri', 'urn:p:c_nationkey', {_NATION}, 'uri', NULL, NULL "
    "FROM customer WHERE c_custkey % 8 = 1"
)


@query("decode_construct", _CONSTRUCTED)
def decode_construct(spark, sf_dir):
    return responses.construct_quads_of(V.responses(spark, sf_dir, "construct"))


@query(
    "decode_construct_outcomes",
    R + "SELECT request_id, status = 200 AND content_type <> 'application/rdf+xml' AND body NOT LIKE '%broken%' AS success, coalesce(status, 0) AS status, "
    "CASE WHEN transport_error IS NOT NULL THEN transport_error WHEN status <> 200 THEN body "
    "WHEN content_type = 'application/rdf+xml' THEN 'unsupported Content-Type: application/rdf+xml' "
    "WHEN body LIKE '%broken%' THEN 'malformed body' END AS error, "
    "CASE WHEN transport_error IS NOT NULL THEN 'no response' "
    "WHEN status <> 200 THEN 'status is not 200, error holds the body' END AS message "
    "FROM (SELECT * REPLACE (coalesce(status, -1) AS status) FROM responses WHERE route = 'construct')".replace(
        "coalesce(status, 0) AS status", "greatest(status, 0) AS status"
    ).replace("status = 200 AND content_type <> 'application/rdf+xml' AND body NOT LIKE '%broken%' AS success",
              "coalesce(status = 200 AND content_type <> 'application/rdf+xml' AND body NOT LIKE '%broken%', false) AS success"),
)
def decode_construct_outcomes(spark, sf_dir):
    return responses.decode_construct(V.responses(spark, sf_dir, "construct"))


_GRAPH_SIZE = (
    "CASE WHEN content_type LIKE 'text/turtle%' AND body NOT LIKE '%broken%' THEN 2 "
    "WHEN content_type = 'application/ld+json' AND body NOT LIKE '%broken%' THEN 3 WHEN status = 200 AND body LIKE '%orderstatus%' THEN 2 WHEN status = 200 AND body LIKE '<urn%' "
    "AND body NOT LIKE '%broken%' THEN 1 END"
)


@query(
    "decode_graph",
    R + "SELECT request_id, CASE WHEN status IN (200, 204) THEN true WHEN status = 404 THEN false END AS success, status, "
    "CASE WHEN status = 500 THEN 'status code outside the known ones: 500' END AS error, "
    f"CAST({_GRAPH_SIZE} AS BIGINT) AS n FROM responses WHERE route = 'graph' AND transport_error IS NULL",
)
def decode_graph(spark, sf_dir):
    return responses.graph_outcomes(V.responses(spark, sf_dir, "graph"))


@query(
    "empty_payload",
    R + f"SELECT coalesce(length(body), 0) = 0 AS empty, {_GRAPH_SIZE} IS NOT NULL AS has_model, count(*) AS n "
    "FROM responses WHERE route = 'graph' AND transport_error IS NULL AND status IN (200, 204) GROUP BY ALL",
)
def empty_payload(spark, sf_dir):
    raw = V.responses(spark, sf_dir, "graph").where(F.col("status").isin(200, 204))
    decoded = responses.decode_graph(raw).select("request_id", "has_model")
    joined = raw.select("request_id", (F.coalesce(F.length("body"), F.lit(0)) == 0).alias("empty")).join(
        decoded, "request_id", "left"
    )
    return joined.groupBy("empty", "has_model").agg(F.count(F.lit(1)).alias("n"))


@query(
    "swallow_parse_error",
    "SELECT o_orderkey AS request_id, k.s AS s, 'uri' AS s_type, k.p AS p, k.o AS o, k.t AS o_type, k.d AS o_datatype, "
    "CAST(NULL AS VARCHAR) AS o_lang FROM (SELECT *, unnest([{'p': 'urn:p:o_custkey', 's': " + _KEY + ", 'o': " + _CUST
    + ", 't': 'uri', 'd': NULL}, {'p': 'urn:p:o_orderstatus', 's': " + _KEY + ", 'o': o_orderstatus, 't': 'literal', 'd': '"
    + XSD + "string'}]) AS k FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice >= 100000) "
    "WHERE o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_totalprice >= 250000 AND k.t = 'uri') UNION ALL "
    f"SELECT -1 - c_custkey, {_CUSTOMER}, 'uri', 'urn:p:c_nationkey', {_NATION}, 'uri', NULL, NULL FROM customer WHERE c_custkey % 8 = 4 UNION ALL "
    f"SELECT -1 - c_custkey, {_CUSTOMER}, 'uri', 'urn:p:c_mktsegment', c_mktsegment, 'literal', '{RDF_LANGSTRING}', 'en' "
    "FROM customer WHERE c_custkey % 8 = 4 UNION ALL "
    f"SELECT -1 - c_custkey, {_CUSTOMER}, 'uri', 'urn:p:c_acctbal', CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 'literal', '{XSD}decimal', NULL "
    "FROM customer WHERE c_custkey % 8 = 5 UNION ALL "
    f"SELECT -1 - c_custkey, {_CUSTOMER}, 'uri', 'urn:p:knows', CAST(-1 - c_custkey AS VARCHAR) || '.x', 'bnode', NULL, NULL "
    "FROM customer WHERE c_custkey % 8 = 5 UNION ALL "
    f"SELECT -1 - c_custkey, CAST(-1 - c_custkey AS VARCHAR) || '.x', 'bnode', 'urn:p:c_name', c_name, 'literal', '{XSD}string', NULL "
    "FROM customer WHERE c_custkey % 8 = 5",
)
def swallow_parse_error(spark, sf_dir):
    return responses.graph_models(V.responses(spark, sf_dir, "graph"))


@query(
    "response_envelope",
    R + "SELECT request_id, route, status, coalesce(status = 200, false) AS success, "
    "CASE WHEN transport_error IS NOT NULL THEN 'no response: transport failed' "
    "WHEN status <> 200 THEN 'response status ' || CAST(status AS VARCHAR) END AS error FROM responses",
)
def response_envelope(spark, sf_dir):
    rows = responses.envelope(V.responses(spark, sf_dir))
    return rows.select("request_id", "route", "status", "success", "error")


@query(
    "stream_raw",
    R + "SELECT request_id, coalesce(status = 200, false) AS success, status, content_type, body, "
    "CASE WHEN transport_error IS NOT NULL THEN 'query not run' END AS error "
    "FROM responses WHERE route = 'query'",
)
def stream_raw(spark, sf_dir):
    return responses.stream_raw(V.responses(spark, sf_dir, "query"))


@query(
    "zip_response",
    R + "SELECT request_id, status, coalesce(status = 200, false) AS ok, "
    f"CASE WHEN status IS DISTINCT FROM 200 THEN false WHEN {_MEDIA} = 'text/boolean' THEN lower(body) = 'true' "
    "ELSE true END AS success FROM responses WHERE route = 'update'",
)
def zip_response(spark, sf_dir):
    raw = V.responses(spark, sf_dir, "update")
    envelopes = responses.envelope(raw).select("request_id", "status", F.col("success").alias("ok"))
    payloads = responses.decode_update(raw).select("request_id", "success")
    return responses.zip_response(envelopes, payloads)


@query(
    "merge_responses",
    R + "SELECT route, count(*) AS n, count(*) FILTER (CASE route WHEN 'query' THEN coalesce(body LIKE '%bindings%', false) "
    f"WHEN 'update' THEN status = 200 AND ({_MEDIA} <> 'text/boolean' OR lower(body) = 'true') "
    "WHEN 'construct' THEN status = 200 AND content_type <> 'application/rdf+xml' AND body NOT LIKE '%broken%' END) AS n_success "
    "FROM responses WHERE route <> 'graph' GROUP BY route",
)
def merge_responses(spark, sf_dir):
    of = lambda name, out: out.select(F.lit(name).alias("route"), "request_id", "success", "error")
    merged = responses.merge_responses(
        of("query", responses.decode_select(V.responses(spark, sf_dir, "query"))),
        of("update", responses.decode_update(V.responses(spark, sf_dir, "update"))),
        of("construct", responses.decode_construct(V.responses(spark, sf_dir, "construct"))),
    )
    return merged.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("n_success")
    )


# --- solutions --------------------------------------------------------------------------------


@query(
    "map_solutions",
    f"WITH sols AS ({_SOLUTIONS}) SELECT request_id, \"order\" AS id, "
    "regexp_replace(\"order\", '^.*[/#]', '') AS name, customer AS customer, total AS total FROM sols",
)
def map_solutions(spark, sf_dir):
    return solutions.map_solutions(
        _solutions(spark, sf_dir),
        [("id", "order", "iri"), ("name", "order", "local_name"), ("customer", "customer", "iri"),
         ("total", "total", "string")],
        keep=["request_id"],
    )


@query(
    "map_delegate",
    f"WITH sols AS ({_SOLUTIONS}) SELECT request_id, upper(\"order\") AS label, customer IS NOT NULL AS known FROM sols",
)
def map_delegate(spark, sf_dir):
    def describe(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"request_id": batch["request_id"], "label": batch["order"].str.upper(), "known": batch["customer"].notna()}
        )

    rows = _solutions(spark, sf_dir).select("request_id", "order", "customer")
    return solutions.map_delegate(rows, describe, "request_id bigint, label string, known boolean")


@query("map_iri_field", f"WITH sols AS ({_SOLUTIONS}) SELECT \"order\" FROM sols")
def map_iri_field(spark, sf_dir):
    return solutions.map_iri_field(_solutions(spark, sf_dir), "order")


@query("map_string_field", "SELECT c_name AS name FROM customer")
def map_string_field(spark, sf_dir):
    rows = bgp.bgp_join(V.quads(spark, sf_dir), [("?c", "urn:p:c_name", "?name", "?g")])
    return solutions.map_string_field(rows, "name")


@query(
    "write_results_json",
    "SELECT '{\"c\":{\"type\":\"uri\",\"value\":\"urn:customer:' || CAST(c_custkey AS VARCHAR) || '\"},"
    "\"bal\":{\"type\":\"literal\",\"datatype\":\"" + XSD + "decimal\",\"value\":\"' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) "
    "|| '\"},\"seg\":{\"type\":\"literal\",\"value\":\"' || c_mktsegment || '\"}}' AS value FROM customer",
)
def write_results_json(spark, sf_dir):
    quads = V.quads(spark, sf_dir, ["urn:g:customer"])
    rows = bgp.bgp_join(
        quads, [("?c", "urn:p:c_acctbal", "?bal", "?g"), ("?c", "urn:p:c_mktsegment", "?seg", "?g")]
    )
    return writers.to_solution_json(rows, ["c", "bal", "seg"]).select("value")


@query(
    "write_results_document",
    f"WITH sols AS ({_SOLUTIONS}) SELECT request_id, count(*) AS n, count(customer) AS customers, "
    "max(\"order\") AS last FROM sols GROUP BY request_id",
)
def write_results_document(spark, sf_dir):
    docs = writers.to_results_json(_solutions(spark, sf_dir), VARS, "request_id", "row_no")
    back = solutions.read_results_json(docs, VARS, mode="FAILFAST")
    return back.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("customer").alias("customers"), F.max("order").alias("last")
    )
