"""Join orders from characteristic sets."""

import pytest

from quadrille.operators import bgp
from quadrille.operators.join_order import Estimates, Statistics, characteristic_sets, order_by_size, predicate_statistics
from quadrille.schema import literal

from .data import frame, text, uri

A, B, C, L = "urn:a", "urn:b", "urn:c", "urn:link"


@pytest.fixture(scope="module")
def shop(spark):
    """a and b are common but on the same subject 3 times only; c is rarer, and always beside a."""
    rows = []
    for i in range(60):
        rows.append(text("urn:g", f"urn:s:{i}", A, f"{i % 7}"))
        rows += [text("urn:g", f"urn:s:{i}", C, f"{k}") for k in range(2) if i < 20]
    rows += [text("urn:g", f"urn:s:{i}", B, "x") for i in range(57, 117)]
    rows += [uri("urn:g", f"urn:s:{i}", L, f"urn:s:{i // 4}") for i in range(40)]
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def statistics(spark, shop, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("statistics"))
    Statistics.write(shop, path)
    return Statistics.read(spark, path)


def handed_on(quads, ordered):
    """Rows that the joins of this order hand on to the next one."""
    total, solutions, bound = 0, None, set()
    for p in ordered:
        found = bgp.match(quads, p)
        shared = [v for v in bgp.variables(p) if v in bound]
        solutions = found if solutions is None else bgp._join(solutions, found, shared, {"x", "y"}, "inner")
        bound |= set(bgp.variables(p))
        total += solutions.count()
    return total


def test_characteristic_sets(shop):
    found = {tuple(r.predicates): (r.named, r.subjects, dict(r.counts)) for r in characteristic_sets(shop).collect()}
    assert found[(A, B)] == (True, 3, {A: 3, B: 3})
    assert found[(A, C, L)] == (True, 20, {A: 20, C: 40, L: 20})
    assert found[(B,)] == (True, 57, {B: 57})
    assert sum(n for _, n, _ in found.values()) == 117


def test_stars_are_exact(shop, statistics):
    star = [("?x", A, "?p", "?g"), ("?x", B, "?q", "?g"), ("?x", C, "?r", "?g"), ("?x", L, "?y", "?g")]
    for some in (star[:1], star[:2], star[::2], star[1:3], [star[0], star[2], star[3]], [star[2], ("?x", C, "?t", "?g")]):
        assert Estimates(some, statistics).size(some) == bgp.bgp_join(shop, some).count()


def test_order_hands_on_fewer_rows(shop, statistics):
    patterns = [("?x", A, "?p", "?g"), ("?x", C, "?r", "?g"), ("?x", B, "?q", "?g")]
    counts = {r["p"]: r["statements"] for r in statistics.predicates.collect()}
    fixed, chosen = bgp.order_patterns(patterns, counts), order_by_size(patterns, statistics)
    assert {p[1] for p in chosen[:2]} == {B, C}
    assert handed_on(shop, chosen) < handed_on(shop, fixed)
    linked = [("?x", A, "?p", "?g"), ("?x", L, "?y", "?g"), ("?y", B, "?q", "?g"), ("?y", A, "?r", "?g")]
    assert handed_on(shop, order_by_size(linked, statistics)) <= handed_on(shop, bgp.order_patterns(linked, counts))
    for some in (patterns, linked):
        same = [sorted(map(str, bgp.bgp_join(shop, some, statistics=s).select("x", "p", "q", "r").collect())) for s in (None, statistics)]
        assert same[0] == same[1]


def test_ground_terms_and_free_predicates(shop, statistics):
    patterns = [("?x", A, "?p", "?g"), ("?x", "?any", "?o", "?g"), ("?x", B, literal("x"), "?g")]
    assert order_by_size(patterns, statistics)[-1][1] == "?any"
    assert bgp.bgp_join(shop, patterns, statistics=statistics).count() == 6
    star = bgp.bgp_join(shop, [patterns[0], patterns[2]], single_valued=[A, B], statistics=statistics)
    assert star.count() == 3
    with pytest.raises(ValueError):
        order_by_size([("?x", A, "?p"), ("?y", B, "?q")], statistics)


def test_unknown_predicates_and_no_statements(spark, shop, statistics):
    assert bgp.bgp_join(shop, [("?x", A, "?p", "?g"), ("?x", "urn:none", "?q", "?g")], statistics=statistics).count() == 0
    empty = Statistics(characteristic_sets(shop.limit(0)), predicate_statistics(shop.limit(0)))
    assert len(order_by_size([("?x", A, "?p", "?g"), ("?x", "?b", "?q", "?g")], empty)) == 2
