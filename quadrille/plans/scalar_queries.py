"""Queries with scalar functions: terms, prefixes, requests, endpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import terms
from ..operators import prefixes as P
from ..operators import requests as RQ
from ..schema import XSD
from . import views as V
from .registry import query

Q = f"WITH quads AS ({V.QUADS_SQL}) "

#: Namespaces of the entity tables, some inside others.
MAPPING = P.ALL | {
    "p": "urn:p:", "po": "urn:p:o_", "pc": "urn:p:c_", "t": "urn:type:", "customer": "urn:customer:",
    "urn": "urn:", "orders": "urn:orders:",
}
_MAP_SQL = "(VALUES " + ", ".join(f"('{p}', '{ns}')" for p, ns in MAPPING.items()) + ") m(prefix, ns)"


@query(
    "local_name",
    "SELECT page_id, regexp_replace(url, '^.*[/#]', '') AS name FROM pages",
)
def local_name(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select("page_id", terms.local_name("url").alias("name"))


@query(
    "typed_accessors",
    Q + "SELECT s, p, o AS str, CASE WHEN regexp_full_match(trim(o), '[+-]?[0-9]+') THEN TRY_CAST(o AS SMALLINT) END AS short, "
    "CASE WHEN regexp_full_match(trim(o), '[+-]?[0-9]+') THEN TRY_CAST(o AS INTEGER) END AS int, "
    "CAST(CASE WHEN regexp_full_match(trim(o), '[+-]?[0-9]+') THEN TRY_CAST(o AS DECIMAL(38,0)) END AS VARCHAR) AS bigint, "
    "CASE WHEN trim(o) IN ('1', 'true') THEN true WHEN trim(o) IN ('0', 'false') THEN false END AS bool, "
    "CASE WHEN contains(o, ':') THEN o END AS iri FROM quads WHERE o_type = 'literal'",
)
def typed_accessors(spark, sf_dir):
    rows = V.quads(spark, sf_dir).where(F.col("o_type") == "literal")
    kinds = {"str": "string", "short": "short", "int": "int", "bigint": "bigint", "bool": "boolean", "iri": "iri"}
    out = [terms.as_type("o", kind).alias(name) for name, kind in kinds.items()]
    return rows.select("s", "p", *out).withColumn("bigint", F.col("bigint").cast("string"))


_SHORT = (
    f"coalesce((SELECT arg_max(m.prefix || ':' || substr(q.s, length(m.ns) + 1), length(m.ns)) FROM {_MAP_SQL} "
    "WHERE starts_with(q.s, m.ns)), q.s)"
)
_IRIS = Q + ", q AS (SELECT DISTINCT x AS s FROM (SELECT s AS x FROM quads UNION ALL SELECT p FROM quads UNION ALL "
_IRIS += "SELECT o FROM quads WHERE o_type = 'uri' UNION ALL SELECT url FROM pages)) "


def _iris(spark, sf_dir):
    """Every IRI in use once: from subjects, predicates and objects, and the page addresses."""
    quads = V.quads(spark, sf_dir)
    used = quads.select(F.explode(F.array("s", "p", F.when(F.col("o_type") == "uri", F.col("o")))).alias("s"))
    pages = V.table(spark, sf_dir, "pages").select(F.col("url").alias("s"))
    return used.where(F.col("s").isNotNull()).unionByName(pages).distinct()


@query("short_form", _IRIS + f"SELECT s, {_SHORT} AS short FROM q")
def short_form(spark, sf_dir):
    return _iris(spark, sf_dir).select("s", P.short_form("s", MAPPING).alias("short"))


@query(
    "expand_prefix",
    _IRIS + f", short AS (SELECT s, {_SHORT} AS short FROM q) SELECT short, coalesce((SELECT m.ns || substr(short, instr(short, ':') + 1) "
    f"FROM {_MAP_SQL} WHERE m.prefix = split_part(short, ':', 1)), short) AS expanded FROM short",
)
def expand_prefix(spark, sf_dir):
    short = _iris(spark, sf_dir).select(P.short_form("s", MAPPING).alias("short"))
    return short.select("short", P.expand_prefix("short", MAPPING).alias("expanded"))


@query(
    "is_prefixed",
    _IRIS + f"SELECT s, contains(s, ':') AND split_part(s, ':', 1) IN (SELECT prefix FROM {_MAP_SQL}) AS yes FROM q",
)
def is_prefixed(spark, sf_dir):
    return _iris(spark, sf_dir).select("s", P.is_prefixed("s", MAPPING).alias("yes"))


_LOCAL = "regexp_extract(s, '([A-Za-z_][A-Za-z0-9_.-]*)$', 1)"


@query("split_namespace", _IRIS + f"SELECT s, CAST(length(s) - length({_LOCAL}) AS INTEGER) AS at FROM q")
def split_namespace(spark, sf_dir):
    return _iris(spark, sf_dir).select("s", terms.namespace_split("s").alias("at"))


@query(
    "qname_for",
    _IRIS + f", cut AS (SELECT s, {_LOCAL} AS l FROM q) SELECT s, CASE WHEN l <> '' THEN (SELECT max(m.prefix) || ':' || l "
    f"FROM {_MAP_SQL} WHERE m.ns = left(s, length(s) - length(l))) END AS qname FROM cut",
)
def qname_for(spark, sf_dir):
    return _iris(spark, sf_dir).select("s", P.qname_for("s", MAPPING).alias("qname"))


@query(
    "ns_lookup",
    _IRIS + f"SELECT s, (SELECT ns FROM {_MAP_SQL} WHERE prefix = split_part(s, ':', 2)) AS uri, "
    f"(SELECT max(prefix) FROM {_MAP_SQL} WHERE ns = regexp_extract(s, '^.*[:/#]')) AS prefix FROM q",
)
def ns_lookup(spark, sf_dir):
    second = F.get(F.split("s", ":"), 1)
    return _iris(spark, sf_dir).select(
        "s", P.ns_uri(second, MAPPING).alias("uri"),
        P.ns_prefix(F.regexp_extract("s", "^.*[:/#]", 0), MAPPING).alias("prefix"),
    )


@query(
    "check_prefix",
    Q + "SELECT o, regexp_full_match(o, '([A-Za-z_][A-Za-z0-9_.-]*)?') AS legal FROM "
    "(SELECT DISTINCT o FROM quads WHERE o_type = 'literal')",
)
def check_prefix(spark, sf_dir):
    words = V.quads(spark, sf_dir).where(F.col("o_type") == "literal").select("o").distinct()
    return words.select("o", P.check_prefix("o", F.lit("urn:x:"), "PERMISSIVE").alias("legal"))


@query(
    "standard_prefixes",
    Q + f"SELECT m.prefix, m.ns, count(*) AS n FROM quads JOIN (VALUES "
    + ", ".join(f"('{p}', '{ns}')" for p, ns in P.ALL.items())
    + ") m(prefix, ns) ON starts_with(o_datatype, m.ns) OR (o_datatype IS NULL AND starts_with(p, m.ns)) GROUP BY ALL",
)
def standard_prefixes(spark, sf_dir):
    used = V.quads(spark, sf_dir).select(F.coalesce("o_datatype", "p").alias("iri"))
    counted = used.select(P.longest_namespace("iri", P.ALL).alias("ns")).where("ns IS NOT NULL")
    return counted.groupBy("ns").agg(F.count(F.lit(1)).alias("n")).join(P.prefix_table(spark, P.ALL), "ns")


# --- prefix tables ----------------------------------------------------------------------------

_A, _B = V.prefixes_sql(V.PREFIXES), V.prefixes_sql(V.OTHER_PREFIXES)
_AB = f"WITH a AS ({_A}), b AS ({_B}) "


def _tables(spark, sf_dir):
    return V.prefixes(spark, sf_dir), V.prefixes(spark, sf_dir, V.OTHER_PREFIXES)


@query(
    "prefix_join",
    Q + f", a AS ({_A}), iris AS (SELECT DISTINCT s FROM quads WHERE p = 'urn:p:c_name'), "
    "hits AS (SELECT s, arg_max(prefix, length(ns)) AS prefix, arg_max(ns, length(ns)) AS ns FROM iris JOIN a ON starts_with(s, ns) GROUP BY s) "
    "SELECT q.s, q.p, h.prefix, h.ns FROM quads q LEFT JOIN hits h USING (s) WHERE q.g = 'urn:g:customer'",
)
def prefix_join(spark, sf_dir):
    rows = V.quads(spark, sf_dir, ["urn:g:customer"])
    return P.prefix_join(rows, "s", V.prefixes(spark, sf_dir)).select("s", "p", "prefix", "ns")


@query(
    "prefix_union",
    _AB + "SELECT prefix, ns FROM b UNION ALL SELECT prefix, ns FROM a WHERE prefix NOT IN (SELECT prefix FROM b)",
)
def prefix_union(spark, sf_dir):
    return P.prefix_set(*_tables(spark, sf_dir))


@query(
    "prefix_defaults",
    _AB + "SELECT prefix, ns FROM a UNION ALL SELECT min(prefix), ns FROM b WHERE prefix NOT IN (SELECT prefix FROM a) "
    "AND ns NOT IN (SELECT ns FROM a) GROUP BY ns",
)
def prefix_defaults(spark, sf_dir):
    return P.prefix_defaults(*_tables(spark, sf_dir))


@query(
    "prefix_remove",
    _AB + "SELECT max(prefix) AS prefix, ns FROM (SELECT * FROM a UNION SELECT * FROM b) "
    "WHERE prefix NOT IN ('c1', 'c2', 's3') GROUP BY ns",
)
def prefix_remove(spark, sf_dir):
    a, b = _tables(spark, sf_dir)
    rest = P.prefix_remove(a.unionByName(b).distinct(), ["c1", "c2", "s3"])
    return P.reverse_table(rest)


@query(
    "prefix_equal",
    _AB + "SELECT 'self' AS what, true AS equal UNION ALL SELECT 'other', false",
)
def prefix_equal(spark, sf_dir):
    a, b = _tables(spark, sf_dir)
    same = P.prefix_equal(a, V.prefixes(spark, sf_dir)).select(F.lit("self").alias("what"), "equal")
    return same.unionByName(P.prefix_equal(a, b).select(F.lit("other").alias("what"), "equal"))


# --- requests ---------------------------------------------------------------------------------


def _enc(text: str) -> str:
    return f"replace(replace(url_encode({text}), '%20', '+'), '%2A', '*')"


_K = "CAST(o_orderkey AS VARCHAR)"
_CANONICAL = (
    "SELECT o_orderkey AS request_id, concat_ws('&', 'query=' || "
    + _enc("'select * where { ?s <urn:p:o_custkey> <urn:customer:' || CAST(o_custkey AS VARCHAR) || '> }'")
    + ", CASE WHEN o_orderpriority <> '5-LOW' THEN '$s=' || " + _enc(f"'<urn:orders:' || {_K} || '>'")
    + " || '&$total=' || " + _enc(f"'\"' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '\"^^<{XSD}decimal>'")
    + " END, CASE WHEN o_orderstatus = 'O' THEN 'default-graph-uri=' || " + _enc("'<urn:g:orders>'")
    + " || '&default-graph-uri=' || " + _enc("'<urn:g:customer>'")
    + " END, CASE WHEN o_orderstatus = 'F' THEN 'named-graph-uri=' || " + _enc("'<urn:g:' || o_orderpriority || '>'")
    + " END, CASE WHEN o_orderpriority = '5-LOW' THEN 'limit=' || CAST(o_custkey AS VARCHAR) END, "
    f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'P' THEN 'offset=' || {_K} END, "
    "CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_totalprice > 100000 THEN 'reasoning=true' ELSE 'reasoning=false' END END, "
    "CASE WHEN o_totalprice > 200000 THEN 'timeout=5000' END) AS request_key FROM orders"
)


@query("canonical_request", _CANONICAL)
def canonical_request(spark, sf_dir):
    return V.requests(spark, sf_dir).select("request_id", RQ.canonical_request().alias("request_key"))


@query(
    "parse_request",
    "SELECT o_orderkey AS request_id, 'select * where { ?s <urn:p:o_custkey> <urn:customer:' || CAST(o_custkey AS VARCHAR) || '> }' AS query, "
    f"CASE WHEN o_orderpriority <> '5-LOW' THEN 'urn:orders:' || {_K} END AS bound_s, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS bound_total, "
    f"CASE WHEN o_orderpriority <> '5-LOW' THEN '{XSD}decimal' END AS bound_type, "
    "CASE WHEN o_orderstatus = 'O' THEN 'urn:g:orders urn:g:customer' ELSE '' END AS default_graphs, "
    "CASE WHEN o_orderstatus = 'F' THEN 'urn:g:' || o_orderpriority ELSE '' END AS named_graphs, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey END AS \"limit\", "
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'P' THEN o_orderkey END AS \"offset\", "
    "CASE WHEN o_orderstatus = 'P' THEN o_totalprice > 100000 END AS reasoning, "
    "CASE WHEN o_totalprice > 200000 THEN CAST(5000 AS BIGINT) END AS timeout FROM orders",
)
def parse_request(spark, sf_dir):
    keyed = V.requests(spark, sf_dir).select("request_id", RQ.canonical_request().alias("request_key"))
    parsed = RQ.parse_requests(keyed)
    s, total = F.element_at("bindings", "s"), F.element_at("bindings", "total")
    return parsed.select(
        "request_id", "query", s["value"].alias("bound_s"), total["value"].alias("bound_total"),
        total["datatype"].alias("bound_type"),
        F.array_join("default_graphs", " ").alias("default_graphs"),
        F.array_join("named_graphs", " ").alias("named_graphs"),
        "limit", "offset", "reasoning", "timeout",
    )


@query(
    "route_requests",
    "SELECT CASE WHEN o_orderstatus = 'F' THEN 'update' WHEN o_orderpriority = '3-MEDIUM' THEN 'construct' "
    "WHEN o_orderpriority = '5-LOW' THEN 'query.streamed' ELSE 'query.mapped' END AS route, count(*) AS n FROM orders GROUP BY ALL",
)
def route_requests(spark, sf_dir):
    routed = V.requests(spark, sf_dir).select(RQ.route().alias("route"))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


_PARTS = "regexp_matches(url, '^(https?://)?([a-zA-Z\\-.0-9]+)(:\\d{1,6})?(/.+)?$')"


@query(
    "parse_endpoint",
    f"SELECT page_id, CASE WHEN {_PARTS} AND starts_with(url, 'https://') THEN 'https' ELSE 'http' END AS protocol, "
    f"CASE WHEN {_PARTS} THEN split_part(split_part(url, '/', 3), ':', 1) ELSE 'localhost' END AS host, "
    f"CASE WHEN {_PARTS} AND starts_with(url, 'https://') THEN 443 ELSE 80 END AS port, "
    f"CASE WHEN {_PARTS} THEN substr(url, instr(url, '://') + 3 + length(split_part(url, '/', 3))) ELSE '' END AS path FROM pages",
)
def parse_endpoint(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    return pages.select("page_id", RQ.parse_endpoint("url").alias("e")).select("page_id", "e.*")


@query(
    "endpoint_url",
    f"SELECT page_id, CASE WHEN {_PARTS} THEN url ELSE 'http://localhost' END AS url FROM pages",
)
def endpoint_url(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    e = pages.select("page_id", RQ.parse_endpoint("url").alias("e"))
    url = RQ.endpoint_url(F.col("e.protocol"), F.col("e.host"), F.col("e.port"), F.col("e.path"))
    return e.select("page_id", url.alias("url"))


@query("format_date", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0000' AS at FROM events")
def format_date(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select("event_id", terms.format_date("ts").alias("at"))


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_field(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "struct<k:int>")["k"].alias("k")
    )
