"""Prefix mappings: short and full forms of IRIs.

A mapping of a size that code may hold is a ``dict`` and becomes part of the expression, so no row
moves. A mapping held in a table is a frame ``(prefix, ns)`` with one row per prefix, and is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import NCNAME, col, namespace_split
from ..schema import RDF, RDFS, XSD

# Well-known namespaces.
STANDARD = {
    "rdfs": RDFS,
    "rdf": RDF,
    "dc": "http://purl.org/dc/elements/1.1/",
    "owl": "http://www.w3.org/2002/07/owl#",
    "xsd": XSD,
}
#: A house namespace is added by the caller: ``EXTENDED | {"house": "https://…/"}``.
EXTENDED = STANDARD | {
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "time": "http://www.w3.org/2006/time#",
    "terms": "http://purl.org/dc/terms/",
}
ALL = EXTENDED | {"uuid": "urn:uuid:"}


def prefix_table(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "prefix string, ns string")


def _literal_map(mapping: dict[str, str]) -> Column:
    if not mapping:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def reverse_of(mapping: dict[str, str]) -> dict[str, str]:
    """Namespace to prefix; of several prefixes the last in order counts."""
    return {ns: prefix for prefix, ns in sorted(mapping.items())}


# --- expressions over a dict ------------------------------------------------------------------


def _head(v: Column) -> Column:
    return F.when(F.instr(v, ":") > 0, F.substring_index(v, ":", 1))


def expand_prefix(value: str | Column, mapping: dict[str, str]) -> Column:
    """``p:local`` in full when ``p`` is known; anything else unchanged."""
    v = col(value)
    ns = F.element_at(_literal_map(mapping), _head(v))
    tail = F.substring(v, F.instr(v, ":") + 1, F.length(v))
    return F.coalesce(F.concat(ns, tail), v)


def is_prefixed(value: str | Column, mapping: dict[str, str]) -> Column:
    """The text before the first colon is a known prefix."""
    return F.coalesce(F.map_contains_key(_literal_map(mapping), _head(col(value))), F.lit(False))


def ns_uri(prefix: str | Column, mapping: dict[str, str]) -> Column:
    """Namespace of a prefix, NULL when unknown."""
    return F.element_at(_literal_map(mapping), col(prefix))


def ns_prefix(ns: str | Column, mapping: dict[str, str]) -> Column:
    """Prefix of a namespace, NULL when unknown."""
    return F.element_at(_literal_map(reverse_of(mapping)), col(ns))


def longest_namespace(uri: str | Column, mapping: dict[str, str]) -> Column:
    """The longest known namespace the IRI starts with, else NULL."""
    u = col(uri)
    longest_first = sorted(set(mapping.values()), key=lambda ns: (-len(ns), ns))
    return F.coalesce(*[F.when(u.startswith(ns), F.lit(ns)) for ns in longest_first])


def short_form(uri: str | Column, mapping: dict[str, str]) -> Column:
    """The IRI with its longest known namespace replaced by the prefix, else unchanged."""
    u = col(uri)
    if not mapping:
        return u
    reverse = reverse_of(mapping)
    forms = [
        F.when(u.startswith(ns), F.concat(F.lit(reverse[ns] + ":"), F.substring(u, F.lit(len(ns) + 1), F.length(u))))
        for ns in sorted(reverse, key=lambda ns: (-len(ns), ns))
    ]
    return F.coalesce(*forms, u)


def qname_for(uri: str | Column, mapping: dict[str, str]) -> Column:
    """``prefix:local`` when the part before the NCName is a known namespace, else NULL."""
    u = col(uri)
    at = namespace_split(u)
    local = F.substring(u, at + 1, F.length(u))
    prefix = ns_prefix(F.substring(u, F.lit(1), at), mapping)
    return F.when(local != "", F.concat(prefix, F.lit(":"), local))


def check_prefix(prefix: str | Column, ns: str | Column, mode: str = "FAILFAST") -> Column:
    """A prefix is empty or an NCName, and its namespace is not NULL; else raise, or give False."""
    p, u = col(prefix), col(ns)
    legal = F.coalesce(p.rlike(f"^(?:{NCNAME})?\\z"), F.lit(False)) & u.isNotNull()
    if mode == "FAILFAST":
        message = F.concat(F.lit("illegal prefix or namespace: "), F.coalesce(p, F.lit("NULL")))
        return F.when(legal, True).otherwise(F.raise_error(message).cast("boolean"))
    return legal


# --- operators over tables --------------------------------------------------------------------


def prefix_join(df: DataFrame, uri: str, prefixes: DataFrame) -> DataFrame:
    """Adds ``prefix`` and ``ns`` of the longest namespace each IRI starts with, from a table.

    A "starts with" join would compare everything with everything. Instead each IRI is cut at the
    lengths that occur among the namespaces, and the cuts are equi-joined. Distinct IRIs only are
    matched, so an IRI on a third of all rows is matched once.
    """
    one_per_ns = reverse_table(prefixes)
    lengths = prefixes.agg(F.collect_set(F.length("ns"))).scalar()
    iris = (
        df.select(F.col(uri).alias("_u")).where(F.col(uri).isNotNull()).distinct().withColumn("_l", lengths)
    )
    fitting = F.filter("_l", lambda n: n <= F.length("_u"))
    cuts = iris.select("_u", F.explode(F.transform(fitting, lambda n: F.substring(F.col("_u"), F.lit(1), n))).alias("ns"))
    best = (
        cuts.join(one_per_ns, "ns")
        .groupBy("_u")
        .agg(F.max(F.struct(F.length("ns").alias("n"), "prefix", "ns")).alias("_m"))
        .select("_u", "_m.prefix", "_m.ns")
    )
    return df.join(best, F.col(uri) == F.col("_u"), "left").select(*df.columns, "prefix", "ns")


def reverse_table(prefixes: DataFrame) -> DataFrame:
    """One prefix per namespace: the last in order."""
    return prefixes.groupBy("ns").agg(F.max("prefix").alias("prefix"))


def prefix_set(mine: DataFrame, other: DataFrame) -> DataFrame:
    """All of ``other`` on top of ``mine``: its namespace wins where both know a prefix. An illegal entry raises."""
    other = other.where(check_prefix("prefix", "ns"))
    both = mine.select("prefix", "ns", F.lit(0).alias("_at")).unionByName(
        other.select("prefix", "ns", F.lit(1).alias("_at"))
    )
    return both.groupBy("prefix").agg(F.max(F.struct("_at", "ns")).alias("_m")).select("prefix", "_m.ns")


def prefix_defaults(mine: DataFrame, other: DataFrame) -> DataFrame:
    """``mine`` with those entries of ``other`` of which neither prefix nor namespace is known.

    When ``other`` has a new namespace twice, its first prefix in order is taken. An illegal entry raises.
    """
    other = other.where(check_prefix("prefix", "ns"))
    new = (
        other.join(mine.select("prefix"), "prefix", "left_anti")
        .join(mine.select("ns"), "ns", "left_anti")
        .groupBy("ns")
        .agg(F.min("prefix").alias("prefix"))
    )
    return mine.select("prefix", "ns").unionByName(new.select("prefix", "ns"))


def prefix_remove(prefixes: DataFrame, gone: Sequence[str]) -> DataFrame:
    """The table without some prefixes. Its reverse is :func:`reverse_table` of the result."""
    return prefixes.where(~F.col("prefix").isin(list(gone)))


def prefix_equal(mine: DataFrame, other: DataFrame) -> DataFrame:
    """One row: ``equal`` is true when both tables map the same prefixes to the same namespaces."""
    l, r = mine.alias("l"), other.alias("r")
    both = l.join(r, F.col("l.prefix") == F.col("r.prefix"), "full")
    return both.agg((F.count_if(~F.col("l.ns").eqNullSafe(F.col("r.ns"))) == 0).alias("equal"))
