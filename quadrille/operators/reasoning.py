"""RDFS entailment (rules 2, 3, 5, 7, 9, 11): domain, range, sub-property, sub-class.

The vocabulary is small next to the data, so it is read out, closed in rounds and written first. The
data is then passed once, joined with what its property and its class entail. Where a vocabulary describes RDFS
itself, and where statements are added to a closure, rounds go on with what is new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, QUAD_SCHEMA, RDF_TYPE, RDFS, same_row, statement_set
from ..session import stage

SUB_CLASS = RDFS + "subClassOf"
SUB_PROPERTY = RDFS + "subPropertyOf"
DOMAIN = RDFS + "domain"
RANGE = RDFS + "range"
_RESERVED = [RDF_TYPE, SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE]


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All ``(sub, sup)`` pairs with a path; ends on cycles too.

    Each round extends the pairs of the last one by all that is known, which doubles the length of
    paths covered, and keeps what is new. Rounds are written to the shared folder.
    """
    known = stage(edges.select("sub", "sup").distinct(), "closure")
    delta = known
    while True:
        longer = delta.alias("a").join(known.alias("b"), F.col("a.sup") == F.col("b.sub"))
        fresh = stage(
            longer.select("a.sub", "b.sup").distinct().join(known, ["sub", "sup"], "left_anti"),
            "closure-delta",
        )
        if fresh.isEmpty():
            return known
        known = stage(known.unionByName(fresh), "closure")
        delta = fresh


def _edges(quads: DataFrame, predicate: str) -> DataFrame:
    """Edges between resources, each a struct of value and type."""
    node = lambda v, t: F.struct(F.col(v).alias("v"), F.col(t).alias("t"))
    return quads.where((F.col("p") == predicate) & (F.col("o_type") != "literal")).select(
        node("s", "s_type").alias("sub"), node("o", "o_type").alias("sup")
    )


def _self_describing(quads: DataFrame) -> bool:
    """The vocabulary says something about RDFS terms themselves."""
    about = F.col("p").isin(SUB_PROPERTY, DOMAIN, RANGE) & F.col("s").isin(_RESERVED)
    into = (F.col("p") == SUB_PROPERTY) & F.col("o").isin(_RESERVED)
    return not quads.where(about | into).isEmpty()


def rdfs_closure(quads: DataFrame) -> DataFrame:
    """The quads and everything they entail, as a set.

    Vocabulary statements of all graphs apply to all graphs; an entailed statement is in the graph
    of the statement it comes from.
    """
    if not _self_describing(quads):
        rules, above = _prepare(_vocabulary(quads))
        return statement_set(_entailed(quads, rules, above))
    return extend_closure(quads.sparkSession.createDataFrame([], QUAD_SCHEMA), quads)


def extend_closure(closure: DataFrame, inserts: DataFrame) -> DataFrame:
    """The closure of a set that is closed already and of some more statements.

    Every round joins what the round before found, and no more, with the rules. Only where that changes the vocabulary
    are the statements so far joined again, with the rules that are new or have grown. A round writes what is
    new in it.
    """
    known, vocabulary = closure, _vocabulary(closure)
    rules, above = _prepare(vocabulary)
    delta = stage(_without(statement_set(inserts), known), "rdfs-delta")
    while not delta.isEmpty():
        found = None
        added = _vocabulary(delta)
        if not added.isEmpty():
            vocabulary = stage(vocabulary.unionByName(added), "vocabulary")
            new_rules, new_above = _prepare(vocabulary)
            found = _entailed(known, _changed(new_rules, rules), _changed(new_above, above), own=False)
            rules, above = new_rules, new_above
        entailed = _entailed(delta, rules, above, own=False)
        found = entailed if found is None else found.unionByName(entailed)
        known = known.unionByName(delta)
        delta = stage(_without(statement_set(found), known), "rdfs-delta")
    return known


def _without(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.alias("n").join(known.alias("k"), same_row("n", "k", QUAD_COLS), "left_anti").select(*QUAD_COLS)


def _changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rules that are not the same as before; all their columns are keys or sorted arrays."""
    return stage(now.exceptAll(before), "changed-rules")


def _sorted(values: str | Column) -> Column:
    return F.array_sort(F.collect_set(values))


def _rules(vocabulary: DataFrame, props: DataFrame, classes: DataFrame) -> DataFrame:
    """``_p, supers, domains, ranges``: all that a statement with a property entails.

    A property has the domains and ranges of the properties above it, and with each class those above it.
    """
    above = props.where(F.col("sup.t") == "uri").select(F.col("sub.v").alias("_p"), F.col("sup.v").alias("_q"))
    supers = above.where("_p != _q").groupBy("_p").agg(_sorted("_q").alias("supers"))
    signature = (
        vocabulary.where(F.col("p").isin(DOMAIN, RANGE) & (F.col("o_type") != "literal"))
        .select(F.col("s").alias("_q"), (F.col("p") == DOMAIN).alias("of_subject"),
                F.struct(F.col("o").alias("v"), F.col("o_type").alias("t")).alias("cls"))
    )
    own = signature.select(F.col("_q").alias("_p"), "_q")
    stated = above.unionByName(own).distinct().join(signature, "_q").select("_p", "of_subject", "cls")
    inherited = stated.join(classes, F.col("cls") == F.col("sub")).select("_p", "of_subject", F.col("sup").alias("cls"))
    types = stated.unionByName(inherited).groupBy("_p").agg(
        _sorted(F.when(F.col("of_subject"), F.col("cls"))).alias("domains"),
        _sorted(F.when(~F.col("of_subject"), F.col("cls"))).alias("ranges"),
    )
    return supers.join(types, "_p", "full")


def _above(closure: DataFrame, kind: str) -> DataFrame:
    """All nodes above each node of a hierarchy, in a row."""
    return closure.groupBy("sub").agg(_sorted("sup").alias("sups")).select(
        F.lit(kind).alias("_kind"), F.col("sub.v").alias("_v"), F.col("sub.t").alias("_t"), "sups")


def _vocabulary(quads: DataFrame) -> DataFrame:
    return stage(quads.where(F.col("p").isin(SUB_PROPERTY, SUB_CLASS, DOMAIN, RANGE)).select(*QUAD_COLS), "vocabulary")


def _prepare(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A written vocabulary, closed: what each property entails, and what is above each property and class."""
    props = transitive_closure(_edges(vocabulary, SUB_PROPERTY))
    classes = transitive_closure(_edges(vocabulary, SUB_CLASS))
    rules = stage(_rules(vocabulary, props, classes), "rules")
    above = stage(_above(props, "p").unionByName(_above(classes, "c")), "above")
    return rules, above


def _entailed(quads: DataFrame, rules: DataFrame, above: DataFrame, own: bool = True) -> DataFrame:
    """One pass over the data: what it entails by the rules, with the statements themselves if ``own``."""
    # Types and sub-classes go up with the classes, sub-properties with the properties.
    kind = F.when(F.col("p").isin(RDF_TYPE, SUB_CLASS), "c").when(F.col("p") == SUB_PROPERTY, "p")
    rows = quads.select(*QUAD_COLS, kind.alias("_k")).join(rules, F.col("p") == F.col("_p"), "left").join(
        above, (F.col("_k") == F.col("_kind")) & (F.col("o") == F.col("_v")) & (F.col("o_type") == F.col("_t")), "left")

    def statement(**changed):
        return F.struct(*[changed.get(c, F.col(c)).cast("string").alias(c) for c in QUAD_COLS])

    def resource(c):
        return {"o": c["v"], "o_type": c["t"], "o_datatype": F.lit(None), "o_lang": F.lit(None)}

    is_a = F.lit(RDF_TYPE)
    if not own:
        rows = rows.where(F.col("_p").isNotNull() | F.col("_kind").isNotNull())
    entailed = [
        *([F.array(statement())] if own else []),
        F.transform("supers", lambda q: statement(p=q)),
        F.transform("domains", lambda c: statement(p=is_a, **resource(c))),
        F.when(F.col("o_type") != "literal", F.transform(
            "ranges", lambda c: statement(s=F.col("o"), s_type=F.col("o_type"), p=is_a, **resource(c)))),
        F.transform("sups", lambda c: statement(**resource(c))),
    ]
    some = F.filter(F.array(*entailed), lambda part: part.isNotNull())
    return rows.select(F.explode(F.flatten(some)).alias("_s")).select("_s.*")
