"""Basic graph patterns: triple patterns that share variables, as joins of the quad table.

A pattern is ``(s, p, o)`` or ``(s, p, o, g)``. Strings ``?x`` are variables, other strings are IRIs,
:class:`~quadrille.schema.Term` gives any term. Without a fourth part a pattern reads the default
graph. Solutions are a bag with columns ``x``, ``x_type``, ``x_datatype``, ``x_lang`` per variable; an
unbound variable is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import OBJECT_COLS, Term, as_term, demand, object_is
from .join_order import Statistics, order_by_size

Pattern = tuple


def is_var(item: object) -> bool:
    return isinstance(item, str) and item.startswith("?")


def variables(pattern: Pattern) -> list[str]:
    """Variables of a pattern in order, once each."""
    return list(dict.fromkeys(t[1:] for t in pattern if is_var(t)))


def _columns_of(position: int) -> list[Column]:
    """Value, type, datatype and language at a position of the quad table."""
    no = F.lit(None).cast("string")
    uri = F.lit("uri")
    return [
        [F.col("s"), F.col("s_type"), no, no],
        [F.col("p"), uri, no, no],
        [F.col(c) for c in OBJECT_COLS],
        [F.col("g"), uri, no, no],
    ][position]


def _ground(position: int, term: Term) -> Column:
    if position == 2:
        return object_is(term)
    if term.type != "uri":
        return F.lit(False) if term.type == "literal" else object_is(term)
    value = _columns_of(position)[0] == term.value
    return value & (F.col("s_type") == "uri") if position == 0 else value


def match_condition(pattern: Pattern) -> Column:
    """Which statements match one triple pattern."""
    scope = F.col("g").isNotNull() if len(pattern) > 3 else F.col("g").isNull()
    conds, seen = [scope], {}
    for position, item in enumerate(pattern):
        if not is_var(item):
            conds.append(_ground(position, as_term(item)))
        elif item in seen:
            here, there = _columns_of(position), _columns_of(seen[item])
            conds.append(reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(here, there)]))
        else:
            seen[item] = position
    return reduce(Column.__and__, conds)


def match(quads: DataFrame, pattern: Pattern) -> DataFrame:
    """Solutions of one triple pattern: a filter and a projection of the scan."""
    out = []
    for v in variables(pattern):
        position = list(pattern).index(f"?{v}")
        names = [v + suffix for suffix in ("", "_type", "_datatype", "_lang")]
        out += [c.alias(n) for c, n in zip(_columns_of(position), names)]
    return quads.where(match_condition(pattern)).select(*out)


def _resource_vars(pattern: Pattern) -> set[str]:
    """Variables that can only be resources, whose type and value settle equality."""
    return {t[1:] for i, t in enumerate(pattern) if is_var(t) and i != 2}


def _join(left: DataFrame, right: DataFrame, shared: Sequence[str], resources: set[str], how: str) -> DataFrame:
    """Join on shared variables. The value is a plain equality, so it is what rows are shuffled by."""
    l, r = left.alias("l"), right.alias("r")
    conds = []
    for v in shared:
        conds.append(F.col(f"l.{v}") == F.col(f"r.{v}"))
        conds.append(F.col(f"l.{v}_type") == F.col(f"r.{v}_type"))
        if v not in resources:
            conds += [
                F.col(f"l.{v}{x}").eqNullSafe(F.col(f"r.{v}{x}")) for x in ("_datatype", "_lang")
            ]
    keep = [F.col(f"r.{c}") for c in right.columns if c not in left.columns]
    return l.join(r, reduce(Column.__and__, conds), how).select("l.*", *keep)


def _selectivity(pattern: Pattern) -> int:
    """Fewer free positions first; a ground subject or object beats a ground predicate."""
    weights = (2, 1, 2, 1)
    return -sum(w for w, t in zip(weights, pattern) if not is_var(t))


def order_patterns(
    patterns: Sequence[Pattern],
    counts: dict[str, int] | None = None,
    after: Sequence[Pattern] = (),
) -> list[Pattern]:
    """Most selective pattern first, then always one that shares a variable with those before.

    ``counts`` may give statements per predicate, to break ties. ``after`` are patterns that are
    joined already.
    """
    rest = sorted(patterns, key=lambda p: (_selectivity(p), (counts or {}).get(p[1], 0)))
    out: list[Pattern] = []
    bound = {v for p in after for v in variables(p)}
    while rest:
        nxt = next((p for p in rest if not bound or bound & set(variables(p))), None)
        if nxt is None:
            raise ValueError("patterns share no variable; their product is not built")
        rest.remove(nxt)
        out.append(nxt)
        bound |= set(variables(nxt))
    return out


def bgp_join(
    quads: DataFrame,
    patterns: Sequence[Pattern],
    counts: dict[str, int] | None = None,
    single_valued: Sequence[str] = (),
    statistics: Statistics | None = None,
) -> DataFrame:
    """All solutions of the patterns together.

    They are joined in the order that ``statistics`` (characteristic sets of the table) estimate as the cheapest; without
    them by their free positions, and ``counts`` of statements per predicate.

    Properties listed in ``single_valued`` have at most one value per subject and graph. Three or more
    such patterns on one subject variable are answered by one aggregation instead of joins; a
    subject that does have two values raises.
    """
    ground = [p for p in patterns if not variables(p)]
    open_patterns = [p for p in patterns if variables(p)]
    held = all_hold(quads, ground) if ground else None
    if not open_patterns:
        return held
    star, others = _star(open_patterns, set(single_valued))
    resources = set().union(*[_resource_vars(p) for p in patterns])
    if statistics is not None:
        ordered = order_by_size(others, statistics, star)
    else:
        ordered = order_patterns(others, counts, star)
    if star:
        solutions = _match_star(quads, star)
    else:
        first, *ordered = ordered
        solutions = match(quads, first)
        star = [first]
    bound = {v for p in star for v in variables(p)}
    for pattern in ordered:
        shared = [v for v in variables(pattern) if v in bound]
        solutions = _join(solutions, match(quads, pattern), shared, resources, "inner")
        bound |= set(variables(pattern))
    if held is not None:
        # The ground patterns are one yes or no for the whole query.
        solutions = solutions.where(held.agg(F.count(F.lit(1)) > 0).scalar())
    return solutions


def all_hold(quads: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """One row (column ``holds``) when every ground pattern has a statement, else none."""
    conds = []
    for pattern in patterns:
        scope = F.col("g").isNotNull() if len(pattern) > 3 else F.col("g").isNull()
        conds.append(reduce(Column.__and__, [_ground(i, as_term(t)) for i, t in enumerate(pattern)], scope))
    found = [F.count_if(c) > 0 for c in conds]
    hits = quads.where(reduce(Column.__or__, conds))
    return hits.agg(reduce(Column.__and__, found).alias("holds")).where("holds")


def optional(
    solutions: DataFrame, quads: DataFrame, patterns: Sequence[Pattern]
) -> DataFrame:
    """OPTIONAL: keep every solution, with the variables of the patterns where they match.

    Shared variables must be bound in all solutions.
    """
    right = bgp_join(quads, patterns)
    names = list(dict.fromkeys(v for p in patterns for v in variables(p)))
    shared = [v for v in names if v in solutions.columns]
    if not shared:
        raise ValueError("the optional part shares no variable; its product is not built")
    resources = set().union(*[_resource_vars(p) for p in patterns])
    unbound = reduce(Column.__or__, [F.col(v).isNull() for v in shared])
    message = F.lit("a variable that the optional part shares is unbound: " + ", ".join(shared))
    return _join(demand(solutions, ~unbound, message), right, shared, resources, "left")


# --- stars ------------------------------------------------------------------------------------


def _star(patterns: Sequence[Pattern], single_valued: set[str]) -> tuple[list[Pattern], list[Pattern]]:
    """The largest set of patterns ``(?x, p, …)`` on single-valued properties, and the others."""
    groups: dict[tuple, list[Pattern]] = {}
    for p in patterns:
        graph = p[3] if len(p) > 3 else None
        free_object = not is_var(p[2]) or p[2] not in (p[0], graph)
        if is_var(p[0]) and not is_var(p[1]) and p[1] in single_valued and free_object:
            groups.setdefault((p[0], graph), []).append(p)
    best = max(groups.values(), key=len, default=[])
    names = [p[2] for p in best if is_var(p[2])]
    if len(best) < 2 or len({p[1] for p in best}) < len(best) or len(set(names)) < len(names):
        return [], list(patterns)
    return best, [p for p in patterns if p not in best]


def _match_star(quads: DataFrame, star: Sequence[Pattern]) -> DataFrame:
    """One scan and one aggregation by subject instead of a join per property."""
    subject, graph = star[0][0][1:], star[0][3] if len(star[0]) > 3 else None
    scope = F.col("g").isNull() if graph is None else F.col("g").isNotNull()
    if graph is not None and not is_var(graph):
        scope = F.col("g") == as_term(graph).value
    wanted = quads.where(scope & F.col("p").isin([p[1] for p in star]))
    per = []
    for i, p in enumerate(star):
        here = F.col("p") == p[1]
        per += [
            F.max(F.when(here, F.struct(*OBJECT_COLS))).alias(f"_o{i}"),
            F.count_if(here).alias(f"_n{i}"),
        ]
    nodes = wanted.groupBy("g", "s", "s_type").agg(*per)
    conds = []
    for i, p in enumerate(star):
        many = F.concat(F.lit(f"more than one value of {p[1]} on "), F.col("s"))
        conds.append(
            F.when(F.col(f"_n{i}") > 1, F.raise_error(many).cast("boolean")).otherwise(F.col(f"_n{i}") == 1)
        )
        if not is_var(p[2]):
            for c, v in as_term(p[2]).columns().items():
                conds.append(F.col(f"_o{i}.{c}").eqNullSafe(v))
    no, uri = F.lit(None).cast("string"), F.lit("uri")
    out = [F.col("s").alias(subject), F.col("s_type").alias(f"{subject}_type"),
           no.alias(f"{subject}_datatype"), no.alias(f"{subject}_lang")]
    if graph is not None and is_var(graph):
        g = graph[1:]
        out += [F.col("g").alias(g), uri.alias(f"{g}_type"), no.alias(f"{g}_datatype"), no.alias(f"{g}_lang")]
    for i, p in enumerate(star):
        if is_var(p[2]):
            v = p[2][1:]
            out += [
                F.col(f"_o{i}.{c}").alias(v + x)
                for c, x in zip(OBJECT_COLS, ("", "_type", "_datatype", "_lang"))
            ]
    return nodes.where(reduce(Column.__and__, conds)).select(*out)


def predicate_counts(quads: DataFrame) -> DataFrame:
    """Statements per predicate: what :func:`order_patterns` can use, computed once per table."""
    return quads.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
