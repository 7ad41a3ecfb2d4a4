"""JSON-LD in expanded form: nodes with ``@id``, ``@type``, and arrays of values per predicate.

Two layouts are read: one node per line (any file size, split over tasks) and a document per file
holding an array of nodes (parallel over files; a JSON document can not be split). Nodes inside nodes are
read level by level, each level a table of all nodes of that depth. Named graphs (``@graph`` inside a node
with ``@id``) are covered one level deep. Contexts and ``@list``, ``@set``, ``@reverse`` are reported as errors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, RDF_LANGSTRING, RDF_TYPE, XSD, XSD_STRING, demand
from ..session import stage

_NODE = "map<string,string>"
#: Keys of a node that are no predicates.
_NO_PREDICATE = ["@id", "@graph", "@index"]
# A native value stands in the text of its object without quotes.
_NATIVE = r'(?<!\\)"@value"\s*:\s*(true|false|-?[0-9][0-9.eE+-]*)\s*[,}]'


def _fresh(path: Column) -> Column:
    """A blank node for a place in a document."""
    return F.concat(F.lit("_:n"), F.lower(F.hex(F.xxhash64(path))))


def _canonical_double(lexical: Column) -> Column:
    """One digit before the point and an exponent, without zeros that mean nothing."""
    text = F.regexp_replace(F.format_string("%.15E", lexical.try_cast("double")), r"E\+", "E")
    return F.regexp_replace(F.regexp_replace(text, r"E(-?)0+(\d)", "E$1$2"), r"(\.\d+?)0+E", "$1E")


def _values(level: DataFrame) -> DataFrame:
    """A row per value of each predicate: ``_p`` and the value as JSON text ``_raw`` and map ``_v``."""
    entries = F.map_entries(F.map_filter("_node", lambda k, _: ~k.isin(*_NO_PREDICATE)))
    pairs = level.select("_scope", "_graph", "_path", "_id", F.explode(entries).alias("_e"))
    each = pairs.select(
        "_scope", "_graph", "_path", "_id", F.col("_e.key").alias("_p"),
        F.posexplode_outer(F.from_json("_e.value", "array<string>")).alias("_at", "_raw"),
    )
    typed = F.create_map(F.lit("@id"), F.col("_raw"))
    value = F.when(F.col("_p") == "@type", typed).otherwise(F.from_json("_raw", _NODE))
    return each.withColumn("_v", value).withColumn(
        "_path", F.concat_ws("/", "_path", "_p", F.col("_at").cast("string")))


def _is_node() -> Column:
    """A value that is a node of its own, or refers to one."""
    other = F.exists(F.map_keys("_v"), lambda k: k.startswith("@") & ~k.isin("@type", *_NO_PREDICATE))
    return F.col("_v").isNotNull() & ~F.map_contains_key("_v", "@value") & ~other


def _nested(values: DataFrame) -> DataFrame:
    """The values that have properties, as nodes of the next level."""
    has_more = F.exists(F.map_keys("_v"), lambda k: ~k.isin(*_NO_PREDICATE))
    return values.where(_is_node() & has_more).select("_scope", "_graph", "_path", _id_of("_v").alias("_id"), F.col("_v").alias("_node"))


def _id_of(node: str) -> Column:
    return F.coalesce(F.element_at(node, "@id"), _fresh(F.concat_ws("/", "_scope", "_path")))


def _statements(values: DataFrame) -> DataFrame:
    """Quad columns of each value, ``wrong`` and ``text``."""
    v = lambda name: F.element_at("_v", name)
    bnode = lambda c: c.startswith("_:")
    label = lambda c: F.when(bnode(c), F.concat("_scope", F.substring(c, F.lit(3), F.length(c)))).otherwise(c)
    kind = lambda c: F.when(bnode(c), "bnode").when(c.isNotNull(), "uri")
    is_literal = F.map_contains_key("_v", "@value") & (F.col("_p") != "@type")
    native = F.nullif(F.regexp_extract("_raw", _NATIVE, 1), F.lit(""))
    native_type = (
        F.when(native.isin("true", "false"), XSD + "boolean").when(native.rlike("^-?[0-9]+$"), XSD + "integer")
        .when(native.isNotNull(), XSD + "double")
    )
    lexical = F.when(v("@type").isNull() & (native_type == XSD + "double"), _canonical_double(native)).otherwise(v("@value"))
    target = F.when(_is_node(), _id_of("_v"))
    out = values.select(
        "_scope",
        F.col("_graph").alias("g"),
        label(F.col("_id")).alias("s"),
        kind(F.col("_id")).alias("s_type"),
        F.when(F.col("_p") == "@type", RDF_TYPE).otherwise(F.col("_p")).alias("p"),
        F.when(is_literal, lexical).otherwise(label(target)).alias("o"),
        F.when(is_literal, "literal").otherwise(kind(target)).alias("o_type"),
        F.when(
            is_literal,
            F.coalesce(v("@type"), F.when(v("@language").isNotNull(), RDF_LANGSTRING), native_type, F.lit(XSD_STRING)),
        ).alias("o_datatype"),
        F.when(is_literal, v("@language")).alias("o_lang"),
        F.concat_ws(" ", "_id", "_p", "_raw").alias("text"),
    )
    wrong = F.col("s").isNull() | F.col("o").isNull() | F.col("p").startswith("@")
    return out.withColumn("wrong", F.coalesce(wrong, F.lit(True)))


def parse_nodes(top: DataFrame) -> DataFrame:
    """Statements of nodes and of all nodes inside them.

    ``top`` has ``_scope`` (in front of blank node labels), ``_graph``, ``_path`` (the place of the node in its
    document) and ``_node`` (``map<string,string>``, values as JSON text).
    """
    level = top.where(F.col("_node").isNotNull()).withColumn("_id", _id_of("_node"))
    levels = []
    while True:
        values = _values(level)
        levels.append(_statements(values))
        level = stage(_nested(values), "nodes")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def read_jsonld(
    spark: SparkSession, path: str | list[str], layout: str = "document", mode: str = "FAILFAST"
) -> DataFrame:
    """Expanded JSON-LD under a path as quads (not yet a set). ``layout`` is document or lines.

    Blank nodes belong to their file. Numbers and truth values keep their type. Modes are those of
    :func:`quadrille.sources.rdf_lines.parse_statements`.
    """
    if layout not in ("document", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    whole = layout == "document"
    lines = {"wholetext": True} if whole else {"lineSep": "\n"}
    texts = spark.read.text(path, **lines).where(F.trim("value") != "")
    scope = F.concat(F.lower(F.hex(F.xxhash64(F.col("_metadata.file_path")))), F.lit("."))
    place = F.lit("") if whole else F.concat(
        F.col("_metadata.file_block_start").cast("string"), F.lit("-"), F.monotonically_increasing_id().cast("string"))
    return parse_documents(texts.select("value", scope.alias("_scope"), place.alias("_place")), mode, whole)


def parse_documents(texts: DataFrame, mode: str = "FAILFAST", arrays: bool = True) -> DataFrame:
    """Documents ``value`` with their ``_scope`` and ``_place``: arrays of nodes, or a node each."""
    parsed = _nodes_of(texts, arrays)
    if mode == "FAILFAST":
        parsed = demand(parsed, F.col("_whole"), F.lit("malformed JSON-LD"))
    found = _found(parsed)
    if mode == "DROPMALFORMED":
        return found.where("not wrong").select(*QUAD_COLS)
    if mode == "FAILFAST":
        return demand(found, ~F.col("wrong"), F.concat(F.lit("unsupported JSON-LD: "), "text")).select(*QUAD_COLS)
    broken = parsed.where("NOT _whole").select(
        *[F.lit(None).cast("string").alias(c) for c in QUAD_COLS], F.col("value").alias("_corrupt_record"))
    return found.select(
        *[F.when(~F.col("wrong"), F.col(c)).alias(c) for c in QUAD_COLS],
        F.when(F.col("wrong"), F.col("text")).alias("_corrupt_record"),
    ).unionByName(broken)


def parse_cells(texts: DataFrame) -> DataFrame:
    """Documents ``value`` with a ``_scope`` each, as quads with ``_scope`` and ``wrong``; a document that can not be
    read as a whole is one row that is ``wrong``. The rows are written, as who reads them wants to know first which
    documents are good."""
    parsed = _nodes_of(texts.withColumn("_place", F.lit("")), True)
    found = _found(parsed).select("_scope", *QUAD_COLS, "wrong")
    broken = parsed.where("NOT _whole").select(
        "_scope", *[F.lit(None).cast("string").alias(c) for c in QUAD_COLS], F.lit(True).alias("wrong"))
    return stage(found.unionByName(broken), "jsonld-bodies")


def _nodes_of(texts: DataFrame, arrays: bool) -> DataFrame:
    """Adds the ``_nodes`` of each document and whether it is ``_whole``."""
    text = F.col("value") if arrays else F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = texts.withColumn("_nodes", F.from_json(text, f"array<{_NODE}>"))
    return parsed.withColumn("_whole", F.coalesce(F.forall("_nodes", lambda n: n.isNotNull()), F.lit(False)))


def _found(parsed: DataFrame) -> DataFrame:
    """The statements of all documents that are whole."""
    each = parsed.where("_whole").select("_scope", "_place", F.posexplode("_nodes").alias("_i", "_node"))
    each = each.select("_scope", F.concat_ws("/", "_place", F.col("_i").cast("string")).alias("_path"), "_node")
    graph = F.element_at("_node", "@id")
    has_graph = F.map_contains_key("_node", "@graph")
    # A node may hold a graph and have properties, which are then outside of that graph.
    own = each.select("_scope", F.lit(None).cast("string").alias("_graph"), "_path", "_node")
    inside = each.where(has_graph).select(
        "_scope", graph.alias("_graph"), "_path",
        F.posexplode(F.from_json(F.element_at("_node", "@graph"), f"array<{_NODE}>")).alias("_j", "_node"))
    inside = inside.select("_scope", "_graph", F.concat_ws("/", "_path", F.lit("@graph"), F.col("_j").cast("string")).alias("_path"), "_node")
    return parse_nodes(stage(own.unionByName(inside), "nodes"))
