"""RDF data derived from the given tables: each view in Spark and, as SQL, for the check.

Every row of a table gives rows of a view, so work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.join_order import Statistics
from ..operators.text_index import TextIndex, write_index
from ..schema import QUAD_COLS, RDF, RDF_LANGSTRING, RDF_TYPE, RDFS, XSD
from ..session import allow_skew_splits, bound_tasks, fresh_path
from ..sources.relational import Entity, to_quads
from ..sources.writers import read_quads, write_quads

ENTITIES = [
    Entity("region", "r_regionkey", {"r_name": "string"}, None),
    Entity("nation", "n_nationkey", {"n_name": "string", "n_regionkey": "-> region"}, "urn:g:nation"),
    Entity(
        "customer", "c_custkey",
        {"c_name": "string", "c_nationkey": "-> nation", "c_acctbal": "decimal", "c_mktsegment": "string"},
        "urn:g:customer",
    ),
    Entity(
        "supplier", "s_suppkey",
        {"s_name": "string", "s_nationkey": "-> nation", "s_acctbal": "decimal"},
        "urn:g:supplier",
    ),
    Entity(
        "part", "p_partkey",
        {"p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
         "p_retailprice": "decimal"},
        "urn:g:part",
    ),
    Entity(
        "orders", "o_orderkey",
        {"o_custkey": "-> customer", "o_orderstatus": "string", "o_totalprice": "decimal",
         "o_orderdate": "dateTime", "o_orderpriority": "string"},
        "urn:g:orders",
    ),
]
DOCUMENTS = Entity(
    "documents", "doc_id", {"text": "@lang", "source": "string", "n_chars": "long"}, "urn:g:documents"
)
BY_TABLE = {e.table: e for e in [*ENTITIES, DOCUMENTS]}

_stored: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    allow_skew_splits(spark)
    bound_tasks(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _store(spark: SparkSession, sf_dir: str, name: str, entities: list[Entity]) -> str:
    """Write the quads of some tables once per application, as a store would hold them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = fresh_path(spark, name)
        parts = [to_quads(table(spark, sf_dir, e.table), e) for e in entities]
        quads = parts[0]
        for part in parts[1:]:
            quads = quads.unionByName(part)
        write_quads(quads, path, is_set=True)
        _stored[key] = path
    return _stored[key]


def quads(spark: SparkSession, sf_dir: str, graphs: list[str | None] | None = None) -> DataFrame:
    """All entity tables as a stored quad table. Region is the default graph."""
    return read_quads(spark, _store(spark, sf_dir, "quads", ENTITIES), graphs)


def quad_statistics(spark: SparkSession, sf_dir: str) -> Statistics:
    """Characteristic sets of the quads, counted once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "quad-statistics")
    if key not in _stored:
        path = fresh_path(spark, "quad-statistics")
        Statistics.write(quads(spark, sf_dir), path)
        _stored[key] = path
    return Statistics.read(spark, _stored[key])


def document_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as quads, their texts whole and tagged with their language."""
    return read_quads(spark, _store(spark, sf_dir, "document-quads", [DOCUMENTS]))


def document_index(spark: SparkSession, sf_dir: str) -> TextIndex:
    """The text index of the documents, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "document-index")
    if key not in _stored:
        path = fresh_path(spark, "document-index")
        write_index(document_quads(spark, sf_dir), path)
        _stored[key] = path
    return TextIndex(spark, _stored[key])


def all_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quads(spark, sf_dir).unionByName(document_quads(spark, sf_dir))


# --- the same in SQL --------------------------------------------------------------------------


def _sql_value(column: str, kind: str) -> tuple[str, str, str, str]:
    if kind.startswith("-> "):
        return f"'urn:{kind[3:]}:' || CAST({column} AS VARCHAR)", "uri", "NULL", "NULL"
    if kind.startswith("@"):
        return column, "literal", f"'{RDF_LANGSTRING}'", kind[1:]
    if kind == "decimal":
        text = f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"
    elif kind == "dateTime":
        text = f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"
    else:
        text = f"CAST({column} AS VARCHAR)"
    return text, "literal", f"'{XSD}{kind}'", "NULL"


def entity_sql(entity: Entity) -> str:
    graph = f"'{entity.graph}'" if entity.graph else "NULL"
    subject = f"'urn:{entity.table}:' || CAST({entity.key} AS VARCHAR)"
    rows = [(RDF_TYPE, f"'urn:type:{entity.table}'", "uri", "NULL", "NULL")]
    rows += [(f"urn:p:{c}", *_sql_value(c, k)) for c, k in entity.columns.items()]
    return " UNION ALL ".join(
        f"SELECT CAST({graph} AS VARCHAR) AS g, {subject} AS s, 'uri' AS s_type, '{p}' AS p, {o} AS o, "
        f"'{t}' AS o_type, CAST({d} AS VARCHAR) AS o_datatype, CAST({l} AS VARCHAR) AS o_lang "
        f"FROM {entity.table}"
        for p, o, t, d, l in rows
    )


QUADS_SQL = " UNION ALL ".join(entity_sql(e) for e in ENTITIES)
DOCUMENTS_SQL = entity_sql(DOCUMENTS)
COLS = ", ".join(QUAD_COLS)


# --- graph log --------------------------------------------------------------------------------

OPS_COLUMNS = {
    "seq": "event_id",
    "op": "CASE event_type WHEN 'signup' THEN 'PUT' WHEN 'error' THEN 'DELETE'"
          " WHEN 'purchase' THEN 'GET' ELSE 'POST' END",
    "g": "concat('urn:u:', CAST(user_id AS VARCHAR(20)))",
}
#: Statements repeat within a graph, so that sizes and sets differ from counts.
PAYLOAD_COLUMNS = {
    "seq": "event_id",
    "s": "concat('urn:user:', CAST(user_id AS VARCHAR(20)))",
    "s_type": "'uri'",
    "p": "concat('urn:p:', event_type)",
    "o": "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR(20))",
    "o_type": "'literal'",
    "o_datatype": f"'{XSD}long'",
    "o_lang": "CAST(NULL AS VARCHAR(20))",
}
PAYLOAD_WHERE = "event_type IN ('signup', 'view', 'click')"


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def _sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(_exprs(columns)) + f" FROM {source}"


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_exprs(OPS_COLUMNS))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(PAYLOAD_WHERE).selectExpr(*_exprs(PAYLOAD_COLUMNS))


OPS_SQL = _sql(OPS_COLUMNS, "events")
PAYLOAD_SQL = _sql(PAYLOAD_COLUMNS, f"events WHERE {PAYLOAD_WHERE}")


# --- responses --------------------------------------------------------------------------------

_K = "CAST(o_orderkey AS VARCHAR(20))"
_C = "CAST(o_custkey AS VARCHAR(20))"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(30))"
_ORDER_TERM = "'\"order\":{\"type\":\"uri\",\"value\":\"urn:orders:', " + _K + ", '\"}'"
_CUSTOMER_TERM = "',\"customer\":{\"type\":\"uri\",\"value\":\"urn:customer:', " + _C + ", '\"}'"
_TOTAL_TERM = f"',\"total\":{{\"datatype\":\"{XSD}decimal\",\"type\":\"literal\",\"value\":\"', {_PRICE}, '\"}}'"
_HEAD = "'{\"head\":{\"vars\":[\"order\",\"customer\",\"total\"]},\"results\":{\"bindings\":['"
_TWO_ROWS = f"concat({_HEAD}, '{{', {_ORDER_TERM}, {_CUSTOMER_TERM}, {_TOTAL_TERM}, '}},{{', {_ORDER_TERM}, {_TOTAL_TERM}, '}}]}}}}')"
_ONE_ROW = f"concat({_HEAD}, '{{', {_ORDER_TERM}, '}}]}}}}')"


def _reified(node: str, p: str, o: str) -> str:
    def line(part: str, value: str) -> str:
        return f"'_:{node} <{RDF}{part}> ', {value}, ' .', chr(10)"

    subject = f"concat('<urn:orders:', {_K}, '>')"
    return ", ".join(
        [line("subject", subject), line("predicate", f"'<{p}>'"), line("object", o),
         line("graph", "'<urn:g:orders>'")]
    )


_CUSTOMER_QUAD = _reified("b0", "urn:p:o_custkey", f"concat('<urn:customer:', {_C}, '>')")
_PRICE_QUAD = _reified(
    "b1", "urn:p:o_totalprice", f"concat(chr(34), {_PRICE}, chr(34), '^^<{XSD}decimal>')"
)
_TRIPLE = f"'<urn:orders:', {_K}, '> <urn:p:o_custkey> <urn:customer:', {_C}, '> .', chr(10)"
_STATUS_TRIPLE = f"'<urn:orders:', {_K}, '> <urn:p:o_orderstatus> ', chr(34), o_orderstatus, chr(34), ' .', chr(10)"

_BAD = "WHEN o_totalprice < 25000 THEN {0} WHEN o_totalprice < 50000 THEN {1} WHEN o_totalprice < 75000 THEN {2} WHEN o_totalprice < 100000 THEN {3}"


def _by_route(query, update, construct, graph) -> str:
    def by_status(values):
        o, f, p_low, p_high = values
        return (
            f"CASE WHEN o_orderstatus = 'O' THEN {o} WHEN o_orderstatus = 'F' THEN {f} "
            f"WHEN o_totalprice < 250000 THEN {p_low} ELSE {p_high} END"
        )

    return (
        f"CASE o_orderpriority WHEN '2-HIGH' THEN {by_status(update)} "
        f"WHEN '3-MEDIUM' THEN {by_status(construct)} "
        f"WHEN '4-NOT SPECIFIED' THEN {by_status(graph)} ELSE {by_status(query)} END"
    )


def _case(bad: list[str], good: str) -> str:
    return "CASE " + _BAD.format(*bad) + f" ELSE {good} END"


_JSON, _BOOL, _NT = "'application/sparql-results+json'", "'text/boolean'", "'application/n-triples'"
RESPONSE_COLUMNS = {
    "request_id": "o_orderkey",
    "route": "CASE o_orderpriority WHEN '2-HIGH' THEN 'update' WHEN '3-MEDIUM' THEN 'construct'"
             " WHEN '4-NOT SPECIFIED' THEN 'graph' ELSE 'query' END",
    "status": _case(["CAST(NULL AS INT)", "404", "500", "204"], "200"),
    "content_type": _case(
        ["CAST(NULL AS VARCHAR(80))", "'text/plain'", "'text/plain'", "CAST(NULL AS VARCHAR(80))"],
        _by_route(
            (_JSON, "'application/sparql-results+json; charset=UTF-8'", _JSON, "'text/html'"),
            (_BOOL, "'text/boolean; charset=UTF-8'", _BOOL, "'text/plain'"),
            ("'application/n-quads'", "'text/x-nquads'", "'application/octet-stream'", "'application/rdf+xml'"),
            (_NT, _NT, _NT, _NT),
        ),
    ),
    "body": _case(
        ["CAST(NULL AS VARCHAR(80))", "'no such thing'", "'server error'", "''"],
        _by_route(
            (_TWO_ROWS, _ONE_ROW, "'{\"head\":{},\"boolean\":true}'", f"concat('<html>', {_K}, '</html>')"),
            ("'true'", "'FALSE'", "'maybe'", "'done'"),
            (
                f"concat({_CUSTOMER_QUAD})", f"concat({_CUSTOMER_QUAD}, {_PRICE_QUAD})",
                f"concat({_CUSTOMER_QUAD})", "'<rdf/>'",
            ),
            (
                f"concat({_TRIPLE}, {_STATUS_TRIPLE}, {_TRIPLE})", "''",
                f"concat({_TRIPLE}, 'broken', chr(10))", f"concat({_TRIPLE})",
            ),
        ),
    ),
    "transport_error": "CASE WHEN o_totalprice < 25000 THEN 'connection reset' ELSE CAST(NULL AS VARCHAR(80)) END",
}

_CK, _CN = "CAST(c_custkey AS VARCHAR(20))", "CAST(c_nationkey AS VARCHAR(20))"
_BALANCE = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR(30))"
_Q, _QQQ, _LF = "chr(34)", "chr(34), chr(34), chr(34)", "chr(10)"
#: What a string of a Turtle body holds, so that it must not be taken for a statement.
LONG_TEXT = f"concat(c_name, {_LF}, '<urn:a> <urn:b> <urn:c> .', {_LF})"
#: Bodies in Turtle and JSON-LD by the last digit of the key to base 8: answers to CONSTRUCT, then graphs; good and broken.
LINKED_BODIES = [
    f"concat('@prefix rdf: <{RDF}> .', {_LF}, 'PREFIX c: <urn:customer:>', {_LF}, '_:q rdf:subject c:', {_CK}, "
    f"' ; rdf:predicate <urn:p:c_name> ;', {_LF}, ' rdf:object ', {_QQQ}, {LONG_TEXT}, {_QQQ}, ' ; rdf:graph <urn:g:customer> .', {_LF})",
    f"concat('[{{\"@id\":\"_:q\",\"{RDF}subject\":[{{\"@id\":\"urn:customer:', {_CK}, '\"}}],\"{RDF}predicate\":[{{\"@id\":\"urn:p:c_nationkey\"}}],"
    f"\"{RDF}object\":[{{\"@id\":\"urn:nation:', {_CN}, '\"}}],\"{RDF}graph\":[{{\"@id\":\"urn:g:customer\"}}]}}]')",
    f"concat('@prefix c: <urn:customer:> .', {_LF}, 'c:', {_CK}, ' broken:name ', {_Q}, 'x', {_Q}, ' .')",
    f"concat('[{{\"@id\":\"urn:customer:', {_CK}, '\",\"urn:p:broken\":[{{\"@list\":[]}}]}}]')",
    f"concat('PREFIX p: <urn:p:>', {_LF}, '<urn:customer:', {_CK}, '> p:c_nationkey <urn:nation:', {_CN}, '> ;', {_LF}, "
    f"'  p:c_mktsegment ', {_Q}, c_mktsegment, {_Q}, '@en .')",
    f"concat('[{{\"@id\":\"urn:customer:', {_CK}, '\",\"urn:p:c_acctbal\":[{{\"@value\":\"', {_BALANCE}, '\",\"@type\":\"{XSD}decimal\"}}],"
    f"\"urn:p:knows\":[{{\"@id\":\"_:x\",\"urn:p:c_name\":[{{\"@value\":\"', c_name, '\"}}]}}]}}]')",
    f"concat('<urn:customer:', {_CK}, '> <urn:p:broken> ', {_QQQ}, 'never closed .', {_LF}, '<urn:a> <urn:b> <urn:c> .')",
    f"concat('[{{\"@id\":\"urn:customer:', {_CK}, '\",\"urn:p:broken\":')",
]
LINKED_COLUMNS = {
    "request_id": "CAST(-1 - c_custkey AS BIGINT)",
    "route": "CASE WHEN c_custkey % 8 < 4 THEN 'construct' ELSE 'graph' END",
    "status": "200",
    "content_type": "CASE WHEN c_custkey % 2 = 0 THEN 'text/turtle; charset=UTF-8' ELSE 'application/ld+json' END",
    "body": "CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(LINKED_BODIES)) + " END",
    "transport_error": "CAST(NULL AS VARCHAR(80))",
}
RESPONSES_SQL = _sql(RESPONSE_COLUMNS, "orders") + " UNION ALL " + _sql(LINKED_COLUMNS, "customer")


def responses(spark: SparkSession, sf_dir: str, route: str | None = None) -> DataFrame:
    """One captured response per order: good ones of each route and every kind of bad one. One per customer in Turtle or
    JSON-LD."""
    out = table(spark, sf_dir, "orders").selectExpr(*_exprs(RESPONSE_COLUMNS)).unionByName(
        table(spark, sf_dir, "customer").selectExpr(*_exprs(LINKED_COLUMNS)))
    return out if route is None else out.where(F.col("route") == route)


CHUNK = 64


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies cut every 64 characters."""
    body = responses(spark, sf_dir).where(F.length("body") > 0)
    n = F.floor((F.length("body") + CHUNK - 1) / CHUNK).cast("int")
    return body.select(
        "request_id", "body", F.explode(F.sequence(F.lit(0), n - 1)).alias("seq")
    ).select(
        "request_id", "seq",
        F.substring("body", F.col("seq") * CHUNK + 1, F.lit(CHUNK)).alias("chunk"),
    )


# --- requests ---------------------------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, with bindings, graphs and paging that differ by its columns."""
    from ..operators.requests import TERM

    o = table(spark, sf_dir, "orders")
    term = lambda v, t, d: F.struct(
        v.alias("value"), F.lit(t).alias("type"), F.lit(d).cast("string").alias("datatype"),
        F.lit(None).cast("string").alias("lang"),
    )
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    low = F.col("o_orderpriority") == "5-LOW"
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("select * where { ?s <urn:p:o_custkey> <urn:customer:"), cust, F.lit("> }")).alias("query"),
        F.when(
            ~low,
            F.create_map(
                F.lit("total"), term(price, "literal", XSD + "decimal"),
                F.lit("s"), term(F.concat(F.lit("urn:orders:"), key), "uri", None),
            ),
        ).cast(f"map<string,{TERM}>").alias("bindings"),
        F.when(F.col("o_orderstatus") == "O", F.array(F.lit("urn:g:orders"), F.lit("urn:g:customer")))
        .otherwise(F.array().cast("array<string>")).alias("default_graphs"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.concat(F.lit("urn:g:"), F.col("o_orderpriority"))))
        .otherwise(F.array().cast("array<string>")).alias("named_graphs"),
        F.when(low, F.col("o_custkey")).alias("limit"),
        F.when(low & (F.col("o_orderstatus") != "P"), F.col("o_orderkey")).alias("offset"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") > 100000).alias("reasoning"),
        F.when(F.col("o_totalprice") > 200000, F.lit(5000).cast("bigint")).alias("timeout"),
        F.when(F.col("o_orderstatus") == "F", "update").when(F.col("o_orderpriority") == "3-MEDIUM", "construct")
        .otherwise("query").alias("kind"),
        F.when(low, "streamed").otherwise("mapped").alias("query_type"),
    )


# --- prefix tables ----------------------------------------------------------------------------

#: Customers name a namespace each; suppliers overlap with them in prefixes and in namespaces.
PREFIXES = ("concat('c', CAST(c_custkey AS VARCHAR(20)))",
            "concat('urn:customer:', CAST(c_custkey AS VARCHAR(20)))", "customer")
OTHER_PREFIXES = ("concat(CASE WHEN s_acctbal > 5000 THEN 's' ELSE 'c' END, CAST(s_suppkey AS VARCHAR(20)))",
                  "concat(CASE WHEN s_nationkey > 12 THEN 'urn:customer:' ELSE 'urn:supplier:' END,"
                  " CAST(s_suppkey AS VARCHAR(20)))", "supplier")


def prefixes(spark: SparkSession, sf_dir: str, which: tuple[str, str, str] = PREFIXES) -> DataFrame:
    prefix, ns, source = which
    return table(spark, sf_dir, source).selectExpr(f"{prefix} AS prefix", f"{ns} AS ns")


def prefixes_sql(which: tuple[str, str, str]) -> str:
    prefix, ns, source = which
    return f"SELECT {prefix} AS prefix, {ns} AS ns FROM {source}"


# --- hierarchy --------------------------------------------------------------------------------

_CLASS = "concat('urn:c:', p_type, ':', replace(p_brand, '#', '-'))"
_SUB_CLASS, _SUB_PROPERTY = RDFS + "subClassOf", RDFS + "subPropertyOf"
#: A class per type and brand under a class per type under a root, with one cycle above the root; parts
#: are instances. Some properties of parts and customers have super-properties, domains and ranges.
_HIERARCHY_ROWS = [
    (f"{_CLASS}", f"'{_SUB_CLASS}'", "concat('urn:c:', p_type)", "part"),
    ("concat('urn:c:', p_type)", f"'{_SUB_CLASS}'", "'urn:c:root'", "part"),
    ("'urn:c:root'", f"'{_SUB_CLASS}'", "'urn:c:top'", "part"),
    ("'urn:c:top'", f"'{_SUB_CLASS}'", "'urn:c:root'", "part"),
    ("concat('urn:part:', CAST(p_partkey AS VARCHAR(20)))", f"'{RDF_TYPE}'", _CLASS, "part"),
    ("'urn:p:c_nationkey'", f"'{_SUB_PROPERTY}'", "'urn:p:located'", "customer"),
    ("'urn:p:located'", f"'{_SUB_PROPERTY}'", "'urn:p:related'", "customer"),
    ("'urn:p:related'", f"'{RDFS}domain'", "'urn:c:agent'", "customer"),
    ("'urn:p:located'", f"'{RDFS}range'", "'urn:c:place'", "customer"),
    ("'urn:c:agent'", f"'{_SUB_CLASS}'", "'urn:c:root'", "customer"),
    ("concat('urn:customer:', CAST(c_custkey AS VARCHAR(20)))", "'urn:p:c_nationkey'",
     "concat('urn:nation:', CAST(c_nationkey AS VARCHAR(20)))", "customer"),
]
HIERARCHY_SQL = " UNION ".join(
    f"SELECT 'urn:g:h' AS g, {s} AS s, 'uri' AS s_type, {p} AS p, {o} AS o, 'uri' AS o_type, "
    f"CAST(NULL AS VARCHAR(80)) AS o_datatype, CAST(NULL AS VARCHAR(80)) AS o_lang FROM {t}"
    for s, p, o, t in _HIERARCHY_ROWS
)


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for source in ("part", "customer"):
        rows = [F.struct(F.expr(s).alias("s"), F.expr(p).alias("p"), F.expr(o).alias("o"))
                for s, p, o, t in _HIERARCHY_ROWS if t == source]
        part = table(spark, sf_dir, source).select(F.explode(F.array(*rows)).alias("r"))
        out = part if out is None else out.unionByName(part)
    no = F.lit(None).cast("string")
    return out.select(
        F.lit("urn:g:h").alias("g"), F.col("r.s").alias("s"), F.lit("uri").alias("s_type"),
        F.col("r.p").alias("p"), F.col("r.o").alias("o"), F.lit("uri").alias("o_type"),
        no.alias("o_datatype"), no.alias("o_lang"),
    ).dropDuplicates()


