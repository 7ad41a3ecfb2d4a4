import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrille.operators import bgp, construct, dataset, update
from quadrille.plans import graph_queries
from quadrille.plans import views as V
from quadrille.schema import QUAD_COLS, RDF_SUBJECT, RDF_TYPE, Term, iri, literal

from .data import ALT, COMMENT, KIND, LABEL, MODEL, as_set, frame, res, rows, text, uri


@pytest.fixture(scope="module")
def quads(spark):
    return frame(spark, rows()).cache()


@pytest.mark.parametrize(
    "args, size",
    [
        ({"graphs": [ALT]}, 5),
        ({"graphs": [MODEL]}, 19),
        ({"graphs": ["urn:shop:none"]}, 0),
        ({"offset": 0, "limit": 20}, 20),
        ({"subjects": [res(0)]}, 5),
        ({"predicates": [LABEL]}, 13),
        ({"objects": [KIND]}, 2),
        ({}, 24),
    ],
)
def test_sizes(quads, args, size):
    out = construct.construct_quads(quads, **args)
    assert out.columns == QUAD_COLS
    assert out.count() == size


def test_duplicates_collapse_and_the_default_graph_is_out(spark, quads):
    extra = frame(spark, [uri(None, res(0), RDF_TYPE, KIND)])
    assert construct.construct_quads(quads.unionByName(quads).unionByName(extra)).count() == 24


def test_literals_are_no_objects(quads):
    assert construct.construct_quads(quads, objects=["Lamp 1"]).count() == 0


def test_lists_may_be_frames_or_long(spark, quads):
    many = [res(0)] + [f"urn:x:{i}" for i in range(1500)]
    assert construct.construct_quads(quads, subjects=many).count() == 5
    listed = spark.createDataFrame([(res(0),)], "s string")
    assert construct.construct_quads(quads, subjects=listed).count() == 5


@pytest.mark.parametrize(
    "filters, size",
    [
        ({LABEL: literal("Lamp 3")}, 2),
        ({RDF_TYPE: iri(KIND)}, 5),
        ({LABEL: literal("Lamp 0"), RDF_TYPE: iri(KIND)}, 3),
        ({LABEL: literal("Lamp 0"), COMMENT: literal("Needs 1 bulbs")}, 0),
    ],
)
def test_filters_hold_in_one_graph(quads, filters, size):
    assert construct.filter_construct(quads, filters).count() == size


def test_filter_with_property_list(quads):
    out = construct.filter_construct(quads, {RDF_TYPE: iri(KIND)}, predicates=[LABEL], graphs=[ALT])
    assert [r.o for r in out.collect()] == ["Old lamp 0"]


def test_blank_node_is_no_constant(quads):
    with pytest.raises(ValueError):
        construct.filter_construct(quads, {LABEL: Term("b", "bnode")})


def test_pages_join_up(spark, quads):
    whole = sorted(rows(), key=lambda r: tuple("" if v is None else v for v in r))
    for skip, limit in ((0, 24), (0, 5), (5, 5), (10, 20), (5, None), (23, 1), (24, 3), (0, 0)):
        got = [tuple(r) for r in dataset.page(quads, skip, limit).collect()]
        want = whole[skip:] if limit is None else whole[skip : skip + limit]
        assert len(got) == len(want) and set(got) == set(want)
    same = frame(spark, rows()[:1] * 50)
    assert dataset.page(same, 10, 30).count() == 30


@pytest.mark.parametrize("top", [0, 1 << 14])
def test_pages_by_top_k_and_by_a_sort_are_the_same(spark, quads, tmp_path, monkeypatch, top):
    monkeypatch.setattr(dataset, "TOP_ROWS", top)
    twice = quads.unionByName(quads).repartition(5)
    whole = sorted(rows() * 2, key=lambda r: tuple("" if v is None else v for v in r))
    for skip, limit in ((0, 5), (7, 9), (40, 30), (0, 0), (3, 45)):
        got = sorted(map(tuple, dataset.page(twice, skip, limit).collect()), key=str)
        assert got == sorted(whole[skip : skip + limit], key=str)


def test_names_in_urls(quads):
    with pytest.raises(ValueError):
        dataset.prebind(bgp.match(quads, ("?x", LABEL, "?n", "?g")), {"two words": iri("urn:x")})


def test_dataset_clause(quads):
    only_named = dataset.dataset_clause(quads, named=[ALT])
    assert only_named.count() == 5 and dataset.default_graph(only_named).count() == 0
    merged = dataset.dataset_clause(quads, [MODEL, ALT])
    assert merged.count() == 23 and dataset.named_graphs(merged).count() == 0


def test_labels_of_any_form_are_put_back(spark, quads):
    """Digests move as bytes, but are no other labels; nodes of ``reify`` need no second exchange, even of repeated quads."""
    again = construct.dereify(construct.reify(quads.unionByName(quads)), is_set=True)
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(str, again.collect())) == sorted(map(str, quads.collect()))
    labels = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "b0", "", "0123456789abcdef" * 2 + "\n"]
    data = [(label, "bnode", RDF_SUBJECT, "urn:s", "uri", None, None) for label in labels]
    nodes = spark.createDataFrame(data, "s string, s_type string, p string, o string, o_type string, o_datatype string, o_lang string")
    bad = construct.dereify(nodes, on_error="PERMISSIVE").collect()
    assert sorted(r["_corrupt_record"] for r in bad) == sorted(labels)


def test_nodes_are_counted_once_after_one_small_exchange(spark, tmp_path):
    """The quads are made a set before they are reified, so no exchange holds a row per node and part."""
    data = [(1, "A", 1, 1.5, "M"), (1, "A", 1, 1.5, "M"), (2, "B", 1, 1.5, "M")]
    spark.createDataFrame(data, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    for e in V.ENTITIES:
        if e.table != "customer":
            spark.createDataFrame([], f"{e.key} long, " + ", ".join(f"{c} string" for c in e.columns)).write.parquet(f"{tmp_path}/{e.table}.parquet")
    found = graph_queries.reify(spark, str(tmp_path))
    n = {(r["p"].rsplit("#")[1], r["o"]): r["n"] for r in found.collect()}
    assert n["graph", "urn:g:customer"] == 10 and n["subject", "urn:customer:1"] == 5 and n["object", "M"] == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "count(distinct" not in plan and "hashpartitioning(_q" in plan


def test_reify_and_back(quads):
    parts = construct.reify(quads)
    assert parts.count() == 4 * 24
    assert as_set(construct.dereify(parts)) == set(rows())


def test_incomplete_node(quads):
    parts = construct.reify(quads).where(~((F.col("p").endswith("graph")) & (F.col("o") == ALT)))
    assert construct.dereify(parts, on_error="DROPMALFORMED").count() == 19
    assert construct.dereify(parts, on_error="PERMISSIVE").where("_corrupt_record IS NOT NULL").count() == 5
    for wanted in (lambda d: d, lambda d: d.select("p"), lambda d: d.groupBy("g").count()):
        with pytest.raises(PySparkException):
            wanted(construct.dereify(parts)).collect()
    with pytest.raises(PySparkException):
        construct.dereify(parts).count()


def test_positional(spark):
    lines = [(1, i, *v) for i, v in enumerate([
        ("urn:s", "uri", None, None), ("urn:p", "uri", None, None), ("x", "literal", "urn:d", None),
        ("urn:g", "uri", None, None), ("urn:s2", "uri", None, None),
    ])]
    df = spark.createDataFrame(lines, "doc int, pos bigint, o string, o_type string, o_datatype string, o_lang string")
    for width in (None, 2):
        out = construct.dereify_positional(df, ["doc"], "pos", width).collect()
        assert [(r.g, r.s, r.p, r.o) for r in out] == [("urn:g", "urn:s", "urn:p", "x")]


def test_bgp_joins_repeated_variables_and_optional(spark):
    data = frame(spark, [
        uri(None, "urn:a", "urn:knows", "urn:b"), uri(None, "urn:b", "urn:knows", "urn:b"),
        text(None, "urn:b", "urn:name", "Bo"), text(None, "urn:a", "urn:name", "urn:b"),
    ])
    pairs = bgp.bgp_join(data, [("?x", "urn:knows", "?y"), ("?y", "urn:name", "?n")])
    assert sorted((r.x, r.y, r.n) for r in pairs.collect()) == [("urn:a", "urn:b", "Bo"), ("urn:b", "urn:b", "Bo")]
    assert [r.x for r in bgp.bgp_join(data, [("?x", "urn:knows", "?x")]).collect()] == ["urn:b"]
    # A literal that looks like an IRI is not that IRI.
    assert bgp.bgp_join(data, [("?s", "urn:name", "?x"), ("?x", "urn:knows", "?y")]).count() == 0
    left = bgp.match(data, ("?x", "urn:knows", "?y"))
    out = bgp.optional(left, data, [("?x", "urn:knows", "?z"), ("?z", "urn:name", "?m")])
    assert out.count() == 2
    with pytest.raises(ValueError):
        bgp.bgp_join(data, [("?a", "urn:name", "?b"), ("?c", "urn:knows", "?d")])


def test_star_is_the_same_as_joins(quads):
    patterns = [("?x", LABEL, "?l", MODEL), ("?x", COMMENT, "?c", MODEL), ("?x", RDF_TYPE, "?t", MODEL)]
    joined = as_set(bgp.bgp_join(quads, patterns).select("x", "l", "c", "t"))
    star = bgp.bgp_join(quads, patterns, single_valued=[LABEL, COMMENT, RDF_TYPE])
    assert as_set(star.select("x", "l", "c", "t")) == joined == {(res(0), "Lamp 0", "Needs 0 bulbs", KIND)}


def test_star_with_two_values_raises(spark):
    data = frame(spark, [text("urn:g", "urn:a", p, o) for p, o in (("urn:1", "x"), ("urn:1", "y"), ("urn:2", "x"), ("urn:3", "x"))])
    patterns = [("?s", f"urn:{i}", f"?o{i}", "?g") for i in (1, 2, 3)]
    assert bgp.bgp_join(data, patterns).count() == 2
    with pytest.raises(PySparkException):
        bgp.bgp_join(data, patterns, single_valued=["urn:1", "urn:2", "urn:3"]).collect()


def test_update_of_a_spelling(spark):
    name, g, clerk = "urn:shop:called", "urn:shop:staff", "urn:shop:clerk:7"
    state = update.insert_data(frame(spark, []), frame(spark, [text(g, clerk, name, "Jon")]))
    state = update.delete_insert_where(
        state, [("?who", name, literal("Jon"))], [("?who", name, literal("Jon"))],
        [("?who", name, literal("John"))], graph=g,
    )
    assert as_set(state) == {text(g, clerk, name, "John")}


def test_ground_update_only_when_all_hold(spark):
    g, s = "urn:shop:plan", "urn:shop:shelf:2"
    both = [(s, "urn:shop:stands", "urn:shop:room:1"), (s, "urn:shop:holds", "urn:shop:item:4")]
    state = frame(spark, [uri(g, *both[0])])
    assert as_set(update.delete_insert_where(state, both, both, both, graph=g)) == {uri(g, *both[0])}
    state = frame(spark, [uri(g, *t) for t in both])
    assert as_set(update.delete_insert_where(state, both, both, [(s, "urn:p", "urn:o")], graph=g)) == {uri(g, s, "urn:p", "urn:o")}


def test_graph_store_sequence(spark):
    """Replace, replace, replace, merge, replace: sizes 1, 1, 1, 2, 1."""
    g = "urn:shop:log"
    payload = lambda o: frame(spark, [text("urn:ignored", "urn:s", "urn:p", o)])
    state = update.graph_replace(frame(spark, []), payload("a"), None)
    assert update.load_graph(payload("a"), None).count() == 1
    sizes = []
    for op, o in ((update.graph_replace, "a"), (update.graph_replace, "b"), (update.graph_merge, "c"), (update.graph_replace, "d")):
        state = op(state, payload(o), g)
        sizes.append(dataset.get_graph(state, g).count())
    assert sizes == [1, 1, 2, 1]
    assert dataset.get_graph(state, None).count() == 1
    assert update.graph_drop(state, None).count() == 1


def test_drop(quads):
    assert update.graph_drop(quads, ALT).count() == 19
    assert update.graph_drop(quads, "urn:none").count() == 24
    with pytest.raises(PySparkException):
        update.graph_drop(quads, "urn:none", silent=False).collect()


def test_delete_where_with_repeated_variable(spark):
    data = frame(spark, [uri(None, "urn:a", "urn:p", "urn:a"), uri(None, "urn:a", "urn:p", "urn:b"), uri("urn:g", "urn:a", "urn:p", "urn:a")])
    assert update.delete_where(data, ("?x", "urn:p", "?x")).count() == 2
    assert update.delete_where(data, ("?s", "?p", "?o")).count() == 1
