"""Request logs: canonical query strings, their inverse, routes, and endpoint addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import col
from ..schema import RDF_LANGSTRING, XSD_STRING

#: Columns of a request row besides its id.
REQUEST_COLS = [
    "query", "bindings", "default_graphs", "named_graphs", "limit", "offset", "reasoning", "timeout"
]
TERM = "struct<value:string,type:string,datatype:string,lang:string>"


def _iri_text(value: Column) -> Column:
    return F.concat(F.lit("<"), value, F.lit(">"))


def term_text(term: Column) -> Column:
    """A term as it is sent: ``<iri>``, ``"lex"^^<datatype>`` or ``"lex"@lang``; a blank node raises."""
    quoted = F.concat(F.lit('"'), term["value"], F.lit('"'))
    return (
        F.when(term["type"] == "uri", _iri_text(term["value"]))
        .when(term["type"] == "bnode", F.raise_error(F.lit("blank node bindings are not allowed")))
        .when(term["lang"].isNotNull(), F.concat(quoted, F.lit("@"), term["lang"]))
        .otherwise(F.concat(quoted, F.lit("^^"), _iri_text(F.coalesce(term["datatype"], F.lit(XSD_STRING)))))
    )


def canonical_request(angle_brackets: bool = True) -> Column:
    """The query string of a request row: equal requests have equal strings.

    Parts come in a fixed order, absent ones are left out, and bindings are sorted by name; a name
    that is not safe in a URL raises. ``angle_brackets=False`` sends graph names bare, as the SPARQL
    protocol has it.
    """

    def binding(e: Column) -> Column:
        bad = F.raise_error(F.concat(F.lit("invalid binding name ["), e["key"], F.lit("]")))
        name = F.when(F.url_encode(e["key"]) == e["key"], e["key"]).otherwise(bad)
        return F.concat(F.lit("$"), name, F.lit("="), F.url_encode(term_text(e["value"])))

    def graphs(key: str, column: str) -> Column:
        wrap = _iri_text if angle_brackets else (lambda c: c)
        return F.transform(
            F.coalesce(F.col(column), F.array().cast("array<string>")),
            lambda g: F.concat(F.lit(f"{key}="), F.url_encode(wrap(g))),
        )

    def plain(key: str, column: str) -> Column:
        part = F.concat(F.lit(f"{key}="), F.col(column).cast("string"))
        return F.when(part.isNotNull(), F.array(part)).otherwise(F.array().cast("array<string>"))

    entries = F.map_entries(F.coalesce("bindings", F.create_map().cast(f"map<string,{TERM}>")))
    by_name = F.array_sort(
        entries, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    )
    parts = F.concat(
        F.array(F.concat(F.lit("query="), F.url_encode("query"))),
        F.transform(by_name, binding),
        graphs("default-graph-uri", "default_graphs"),
        graphs("named-graph-uri", "named_graphs"),
        *[plain(k, k) for k in ("limit", "offset", "reasoning", "timeout")],
    )
    return F.array_join(parts, "&")


_LITERAL = '(?s)^"(.*)"(?:@([A-Za-z0-9-]+)|\\^\\^<([^<>]*)>)?\\z'


def _bare(graph: Column) -> Column:
    return F.when(graph.startswith("<") & graph.endswith(">"), F.substring(graph, F.lit(2), F.length(graph) - 2)).otherwise(graph)


def _term_of(text: Column) -> Column:
    """A term from its text, which is matched once: language, datatype, and what stands between the quotes."""
    fields = F.split(F.regexp_replace(text, _LITERAL, "$2\x01$3\x01$1"), "\x01", 3)

    def term(f: Column) -> Column:
        at = lambda i: F.nullif(F.get(f, F.lit(i)), F.lit(""))
        literal = F.size(f) == 3
        plain = F.when(at(0).isNotNull(), RDF_LANGSTRING).otherwise(XSD_STRING)
        return F.struct(
            F.when(literal, F.get(f, F.lit(2))).otherwise(_bare(text)).alias("value"),
            F.when(literal, "literal").otherwise("uri").alias("type"),
            F.when(literal, F.coalesce(at(1), plain)).alias("datatype"), F.when(literal, at(0)).alias("lang"))

    # Only a text in quotes is cut, whatever characters others have.
    cut = F.when(text.startswith('"'), fields).otherwise(F.array(text))
    return F.get(F.transform(F.array(cut), term), F.lit(0))


def parse_requests(df: DataFrame, query_string: str = "request_key", collect: bool = False) -> DataFrame:
    """Query strings as request columns, next to the other columns; undoes :func:`canonical_request`.

    A string is cut once, at ``&`` and ``=``, and only what is wanted is decoded. Of a name that is given several
    times ``bindings`` has the last value; with ``collect`` it has all of them, in order, as an array per name.
    """
    rest = [c for c in df.columns if c != query_string]
    decode = F.try_url_decode

    def pair(text: Column) -> Column:
        name = F.substring_index(text, "=", 1)
        return F.struct(name.alias("key"), F.substr(text, F.length(name) + 2).alias("value"))

    cut = df.select(*rest, F.transform(F.split(F.col(query_string), "&"), pair).alias("_parts"))
    named = F.filter("_parts", lambda p: p["key"].startswith("$") | p["key"].startswith("%24"))
    entry = lambda p, i: F.struct(
        F.when(p["key"].startswith("$"), F.substr(p["key"], F.lit(2))).otherwise(F.substr(p["key"], F.lit(4))).alias("key"), i.alias("at"),
        F.get(F.transform(F.array(decode(p["value"])), _term_of), F.lit(0)).alias("term"))
    # In order of name and place, so that the values of a name stand together.
    cut = cut.withColumn("_bound", F.array_sort(F.transform(named, entry)))
    other = lambda step: lambda e, i: ~F.coalesce(F.get("_bound", i + step)["key"] == e["key"], F.lit(False))
    if collect:
        firsts = F.filter("_bound", lambda e, i: (i == 0) | other(-1)(e, i))
        bindings = F.transform(firsts, lambda e: F.struct(e["key"].alias("key"), F.transform(
            F.filter("_bound", lambda b: b["key"] == e["key"]), lambda b: b["term"]).alias("value")))
    else:
        bindings = F.transform(F.filter("_bound", other(1)), lambda e: F.struct(e["key"].alias("key"), e["term"].alias("value")))
    values = lambda key: F.transform(F.filter("_parts", lambda p: p["key"] == key), lambda p: decode(p["value"]))
    first = lambda key: decode(F.get(F.filter("_parts", lambda p: p["key"] == key), F.lit(0))["value"])
    return cut.select(
        *rest,
        first("query").alias("query"),
        F.map_from_entries(bindings).alias("bindings"),
        F.transform(values("default-graph-uri"), _bare).alias("default_graphs"),
        F.transform(values("named-graph-uri"), _bare).alias("named_graphs"),
        first("limit").try_cast("bigint").alias("limit"),
        first("offset").try_cast("bigint").alias("offset"),
        first("reasoning").try_cast("boolean").alias("reasoning"),
        first("timeout").try_cast("bigint").alias("timeout"),
    )


def route(kind: str | Column = "kind", query_type: str | Column = "query_type") -> Column:
    """Where a request goes: queries by how their result is wanted, updates and constructs as they are."""
    k, q = col(kind), col(query_type)
    return (
        F.when((k == "query") & (q == "streamed"), "query.streamed")
        .when(k == "query", "query.mapped")
        .when(k.isin("update", "construct"), k)
    )


# --- endpoints --------------------------------------------------------------------------------

# Fixed pattern: [protocol://]host[:port][/path], matched as a whole.
ENDPOINT = "^(?:(https?)://)?([a-zA-Z\\-.0-9]+)(?::(\\d{1,6}))?(/.+)?\\z"


def parse_endpoint(address: str | Column) -> Column:
    """``protocol``, ``host``, ``port``, ``path``, with defaults; a text that is no address is localhost."""
    a = col(address)
    group = lambda i: F.nullif(F.regexp_extract(a, ENDPOINT, i), F.lit(""))
    protocol = F.coalesce(group(1), F.lit("http"))
    port = group(3).cast("int")
    return F.struct(
        protocol.alias("protocol"),
        F.coalesce(group(2), F.lit("localhost")).alias("host"),
        F.coalesce(port, F.when(protocol == "https", 443).otherwise(80)).alias("port"),
        F.coalesce(group(4), F.lit("")).alias("path"),
    )


def endpoint_url(protocol: Column, host: Column, port: Column, path: Column) -> Column:
    """The address in full; the default port of the protocol is left out."""
    default = ((protocol == "http") & (port == 80)) | ((protocol == "https") & (port == 443))
    at = F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port.cast("string")))
    return F.concat(protocol, F.lit("://"), host, at, path)


