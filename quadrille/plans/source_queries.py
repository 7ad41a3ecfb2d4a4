"""Queries that write RDF in a format and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import terms
from ..operators import update
from ..schema import QUAD_COLS, TRIPLE_COLS, XSD, XSD_STRING, statement_set
from ..session import fresh_path
from ..sources import jsonld, rdf_lines, turtle, writers
from . import views as V
from .registry import query

ALL = f"WITH quads AS ({V.QUADS_SQL} UNION ALL {V.DOCUMENTS_SQL}) "
C, TRIPLE = V.COLS, ", ".join(TRIPLE_COLS)


@query("read_ntriples", ALL + f"SELECT DISTINCT CAST(NULL AS VARCHAR) AS g, {TRIPLE} FROM quads")
def read_ntriples(spark, sf_dir):
    path = fresh_path(spark, "nt")
    writers.write_ntriples(V.all_quads(spark, sf_dir), path, compression="gzip")
    return statement_set(rdf_lines.read_ntriples(spark, path))


@query("read_nquads", ALL + f"SELECT DISTINCT {C} FROM quads")
def read_nquads(spark, sf_dir):
    path = fresh_path(spark, "nq")
    writers.write_nquads(V.all_quads(spark, sf_dir), path, compression="gzip")
    return statement_set(rdf_lines.read_nquads(spark, path))


@query(
    "read_turtle",
    f"WITH quads AS ({V.entity_sql(V.BY_TABLE['customer'])} UNION ALL {V.entity_sql(V.BY_TABLE['orders'])}) "
    f"SELECT CAST(NULL AS VARCHAR) AS g, {TRIPLE} FROM quads",
)
def read_turtle(spark, sf_dir):
    """Customers with prefixed names and lists over several lines, orders with full names."""
    head = "@prefix p: <urn:p:> .\n@prefix xsd: <" + XSD + "> .\nPREFIX t: <urn:type:>\n"
    quoted = lambda c: F.concat(F.lit('"'), terms.escape_literal(c.cast("string")), F.lit('"'))
    price = lambda c: quoted(F.col(c).cast("decimal(18,2)"))
    c = V.table(spark, sf_dir, "customer").select(
        F.concat(
            F.lit(head), F.lit("<urn:customer:"), "c_custkey", F.lit("> a t:customer ;\n  p:c_name "),
            quoted(F.col("c_name")), F.lit(" ;\n\tp:c_acctbal\n"), price("c_acctbal"),
            F.lit("^^xsd:decimal ; p:c_mktsegment # a comment\n "), quoted(F.col("c_mktsegment")), F.lit(" ; p:c_nationkey <urn:nation:"), "c_nationkey", F.lit("> ."),
        ).alias("value")
    )
    o = V.table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("<urn:orders:"), "o_orderkey", F.lit("> a <urn:type:orders>; <urn:p:o_custkey> <urn:customer:"),
            "o_custkey", F.lit("> ; <urn:p:o_orderstatus> "), quoted(F.col("o_orderstatus")), F.lit(";<urn:p:o_totalprice> "),
            price("o_totalprice"), F.lit("^^<" + XSD + "decimal> .\n<urn:orders:"), "o_orderkey",
            F.lit("> <urn:p:o_orderpriority> "), quoted(F.col("o_orderpriority")), F.lit(","),
            quoted(F.col("o_orderpriority")), F.lit(";\n<urn:p:o_orderdate> "),
            quoted(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")), F.lit("^^<" + XSD + "dateTime>."),
        ).alias("value")
    )
    path = fresh_path(spark, "ttl")
    c.write.text(path + "/customer")
    o.write.text(path + "/orders")
    return statement_set(turtle.read_turtle(spark, [path + "/customer", path + "/orders"]))


@query(
    "read_jsonld",
    f"WITH quads AS ({V.entity_sql(V.BY_TABLE['part'])}) SELECT {C} FROM quads",
)
def read_jsonld(spark, sf_dir):
    """Parts as nodes of a named graph, a node per line."""
    value = lambda c, t: F.array(
        F.struct(c.cast("string").alias("@value"), *([F.lit(XSD + t).alias("@type")] if t else []))
    )
    node = F.struct(
        F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")).alias("@id"),
        F.array(F.lit("urn:type:part")).alias("@type"),
        value(F.col("p_name"), None).alias("urn:p:p_name"),
        value(F.col("p_brand"), None).alias("urn:p:p_brand"),
        value(F.col("p_type"), "string").alias("urn:p:p_type"),
        value(F.col("p_size"), "int").alias("urn:p:p_size"),
        value(F.col("p_retailprice").cast("decimal(18,2)"), "decimal").alias("urn:p:p_retailprice"),
    )
    graph = F.struct(F.lit("urn:g:part").alias("@id"), F.array(node).alias("@graph"))
    path = fresh_path(spark, "jsonld")
    V.table(spark, sf_dir, "part").select(F.to_json(graph).alias("value")).write.text(path)
    return jsonld.read_jsonld(spark, path, layout="lines")


@query(
    "read_jsonld_document",
    f"WITH quads AS ({V.entity_sql(V.BY_TABLE['supplier'])}) SELECT {C} FROM quads",
)
def read_jsonld_document(spark, sf_dir):
    """Suppliers as nodes of a named graph, a document per nation."""
    value = lambda c, **more: F.array(F.struct(c.cast("string").alias("@value"), *(v.alias(k) for k, v in more.items())))
    node = F.struct(
        F.concat(F.lit("urn:supplier:"), F.col("s_suppkey").cast("string")).alias("@id"),
        F.array(F.lit("urn:type:supplier")).alias("@type"),
        value(F.col("s_name")).alias("urn:p:s_name"),
        F.array(F.struct(F.concat(F.lit("urn:nation:"), F.col("s_nationkey").cast("string")).alias("@id"))).alias("urn:p:s_nationkey"),
        value(F.col("s_acctbal").cast("decimal(18,2)"), **{"@type": F.lit(XSD + "decimal")}).alias("urn:p:s_acctbal"),
    )
    graph = F.struct(F.lit("urn:g:supplier").alias("@id"), F.collect_list(node).alias("@graph"))
    docs = V.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.to_json(F.array(graph)).alias("value"))
    path = fresh_path(spark, "jsonld")
    docs.write.partitionBy("s_nationkey").text(path)
    return jsonld.read_jsonld(spark, path, layout="document")


_LINES = (
    "SELECT '<urn:customer:' || CAST(c_custkey AS VARCHAR) || '> <urn:p:c_name> \"' || c_name || '\" .' AS line, true AS ok, c_custkey FROM customer "
    "UNION ALL SELECT '<urn:customer:' || CAST(c_custkey AS VARCHAR) || '> <urn:p:c_name> \"' || c_name || ' .', false, c_custkey FROM customer "
)


@query(
    "on_error_modes",
    f"WITH l AS ({_LINES}) SELECT CASE WHEN ok THEN 'urn:customer:' || CAST(c_custkey AS VARCHAR) END AS s, "
    "CASE WHEN NOT ok THEN line END AS bad, 2 AS n_modes FROM l WHERE NOT ok UNION ALL "
    f"SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR), NULL, 2 FROM customer",
)
def on_error_modes(spark, sf_dir):
    """Good and broken lines: kept with their text in one mode, dropped in the other."""
    name = F.concat(F.lit("<urn:customer:"), "c_custkey", F.lit("> <urn:p:c_name> \""), "c_name")
    path = fresh_path(spark, "broken")
    V.table(spark, sf_dir, "customer").select(
        F.explode(F.array(F.concat(name, F.lit("\" .")), F.concat(name, F.lit(" .")))).alias("value")
    ).write.text(path)
    kept = rdf_lines.read_ntriples(spark, path, mode="PERMISSIVE").select("s", F.col("_corrupt_record").alias("bad"))
    dropped = rdf_lines.read_ntriples(spark, path, mode="DROPMALFORMED").agg(F.count(F.lit(1)).alias("_n"))
    lines = V.table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("_n"))
    same = dropped.unionByName(lines).agg(F.when(F.min("_n") == F.max("_n"), 2).otherwise(0)).scalar()
    return kept.select("s", "bad", same.alias("n_modes"))


def _nt_sql(graph: bool) -> str:
    esc = "replace(replace(replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r')"
    obj = (
        f"CASE WHEN o_type = 'uri' THEN '<' || o || '>' WHEN o_lang IS NOT NULL THEN '\"' || {esc} || '\"@' || o_lang "
        f"WHEN o_datatype = '{XSD_STRING}' THEN '\"' || {esc} || '\"' ELSE '\"' || {esc} || '\"^^<' || o_datatype || '>' END"
    )
    g = "CASE WHEN g IS NOT NULL THEN '<' || g || '>' END, " if graph else ""
    return ALL + f"SELECT concat_ws(' ', '<' || s || '>', '<' || p || '>', {obj}, {g}'.') AS value FROM quads"


@query("write_ntriples", _nt_sql(False))
def write_ntriples(spark, sf_dir):
    return writers.to_ntriples(V.all_quads(spark, sf_dir))


@query("write_nquads", _nt_sql(True))
def write_nquads(spark, sf_dir):
    return writers.to_nquads(V.all_quads(spark, sf_dir))


@query(
    "write_quads",
    f"WITH quads AS ({V.QUADS_SQL}) SELECT {C} FROM quads WHERE g IS DISTINCT FROM 'urn:g:orders' "
    f"UNION ALL SELECT 'urn:g:orders', {TRIPLE} FROM quads WHERE g = 'urn:g:nation'",
)
def write_quads(spark, sf_dir):
    """A new version of the stored table after one graph was replaced."""
    quads = V.quads(spark, sf_dir)
    after = update.graph_replace(quads, V.quads(spark, sf_dir, ["urn:g:nation"]), "urn:g:orders")
    path = fresh_path(spark, "quads-next")
    writers.write_quads(after, path)
    return writers.read_quads(spark, path).select(*QUAD_COLS)
