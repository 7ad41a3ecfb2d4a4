import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrille.operators import prefixes as P
from quadrille.operators import requests as RQ
from quadrille.schema import XSD

MAP = P.EXTENDED | {"ex": "http://ex/", "deep": "http://ex/deep/"}


def column(spark, values, f):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(f("v")).collect()]


def test_tables():
    assert len(P.STANDARD) == 5 and set(P.STANDARD) < set(P.EXTENDED) < set(P.ALL)
    assert P.ALL["uuid"] == "urn:uuid:"


def test_prefix_functions(spark):
    assert column(spark, ["ex:a:b", "no:a", "plain", ":x"], lambda c: P.expand_prefix(c, MAP)) == ["http://ex/a:b", "no:a", "plain", ":x"]
    assert column(spark, ["ex:a", "no:a", "plain"], lambda c: P.is_prefixed(c, MAP)) == [True, False, False]
    assert column(spark, ["http://ex/deep/x", "http://ex/x", "urn:x"], lambda c: P.short_form(c, MAP)) == ["deep:x", "ex:x", "urn:x"]
    assert column(spark, ["http://ex/x", "http://ex/deep/x/y", "http://ex/"], lambda c: P.qname_for(c, MAP)) == ["ex:x", None, None]
    assert column(spark, ["ex", "zz"], lambda c: P.ns_uri(c, MAP)) == ["http://ex/", None]
    assert column(spark, ["http://ex/", "urn:z"], lambda c: P.ns_prefix(c, MAP)) == ["ex", None]
    assert column(spark, ["", "ok", "é-1", "1no", "a:b", None], lambda c: P.check_prefix(c, F.lit("urn:x"), "PERMISSIVE")) == [True, True, True, False, False, False]
    with pytest.raises(PySparkException):
        column(spark, ["1no"], lambda c: P.check_prefix(c, F.lit("urn:x")))


def test_prefix_tables(spark):
    t = lambda d: P.prefix_table(spark, d)
    mine, other = t({"a": "urn:1", "b": "urn:2"}), t({"a": "urn:9", "c": "urn:2", "d": "urn:4", "e": "urn:4"})
    rows = lambda df: {(r.prefix, r.ns) for r in df.collect()}
    assert rows(P.prefix_set(mine, other)) == {("a", "urn:9"), ("b", "urn:2"), ("c", "urn:2"), ("d", "urn:4"), ("e", "urn:4")}
    assert rows(P.prefix_defaults(mine, other)) == {("a", "urn:1"), ("b", "urn:2"), ("d", "urn:4")}
    assert rows(P.prefix_remove(mine, ["a"])) == {("b", "urn:2")}
    assert rows(P.reverse_table(other)) == {("a", "urn:9"), ("c", "urn:2"), ("e", "urn:4")}
    assert P.prefix_equal(mine, mine).first()[0] is True and P.prefix_equal(mine, other).first()[0] is False


def test_prefix_join_takes_the_longest(spark):
    df = spark.createDataFrame([("http://ex/deep/x",), ("http://ex/y",), ("urn:z",), ("http://ex/y",), (None,)], "u string")
    got = sorted((r.u or "", r.prefix) for r in P.prefix_join(df, "u", P.prefix_table(spark, MAP)).collect())
    assert got == [("", None), ("http://ex/deep/x", "deep"), ("http://ex/y", "ex"), ("http://ex/y", "ex"), ("urn:z", None)]


# --- requests ---------------------------------------------------------------------------------

SCHEMA = (
    f"query string, bindings map<string,{RQ.TERM}>, default_graphs array<string>, named_graphs array<string>, "
    "limit bigint, offset bigint, reasoning boolean, timeout bigint"
)
NS = "http://shop.example/r/"


def uri(v):
    return (v, "uri", None, None)


def lit(v, t):
    return (v, "literal", XSD + t, None)


def keys(spark, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA)
    return [r[0] for r in df.select(RQ.canonical_request()).collect()]


def test_simple_query_string(spark):
    got = keys(spark, ("ask from <urn:shop:stock> { ?lamp a ?kind }", None, None, None, None, None, None, None))
    assert got == ["query=ask+from+%3Curn%3Ashop%3Astock%3E+%7B+%3Flamp+a+%3Fkind+%7D"]


FULL = (
    "select ?s", {"s": uri(NS + "lamp7")}, [NS + "stock", NS + "archive"], [NS + "staff"], 100, 250, True, 5000
)


def test_full_query_string(spark):
    e = "http%3A%2F%2Fshop.example%2Fr%2F"
    assert keys(spark, FULL) == [
        f"query=select+%3Fs&$s=%3C{e}lamp7%3E&default-graph-uri=%3C{e}stock%3E&default-graph-uri=%3C{e}archive%3E"
        f"&named-graph-uri=%3C{e}staff%3E&limit=100&offset=250&reasoning=true&timeout=5000"
    ]


def test_literals_and_bad_bindings(spark):
    row = lambda b: ("select", b, None, None, None, None, None, None)
    bound = {"watts": lit("60", "int"), "colour": lit("warm white", "string"), "price": lit("4.25", "double"), "sold": lit("false", "boolean")}
    (got,) = keys(spark, row(bound))
    decoded = spark.createDataFrame([(got,)], "k string").select(F.url_decode("k")).first()[0]
    parts = [f'${k}="{v[0]}"^^<{v[2]}>' for k, v in sorted(bound.items())]
    assert decoded == "&".join(["query=select", *parts])
    for bad in ({"lamp kind": lit("x", "string")}, {"b": ("n", "bnode", None, None)}):
        with pytest.raises(PySparkException):
            keys(spark, row(bad))


def test_parse_undoes_canonical(spark):
    rows = [
        FULL,
        ("a&b=c %41 é +", {"x": ("hé \"q\"&=", "literal", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString", "fr")}, [], [], None, None, False, None),
        ("", {}, [], [], None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    back = RQ.parse_requests(df.select(RQ.canonical_request().alias("request_key")))
    assert [r.asDict(True) for r in back.collect()] == [r.asDict(True) for r in df.collect()]


def test_a_repeated_name_takes_its_last_value(spark):
    df = spark.createDataFrame([("query=q&$x=%3Curn:a%3E&$y=%3Curn:c%3E&$x=%3Curn:b%3E",)], "request_key string")
    got = RQ.parse_requests(df).first().bindings
    assert {k: v.value for k, v in got.items()} == {"x": "urn:b", "y": "urn:c"}


def test_repeated_names_are_collected(spark):
    df = spark.createDataFrame([(1, "query=q&$x=%3Curn:a%3E&%24y=%22c%22@en&$x=%22b%22&limit=5&limit=6&$x=%3Curn:a%3E"), (2, "query=q"), (3, "")], "id int, request_key string")
    got = {r["id"]: r for r in RQ.parse_requests(df, collect=True).collect()}
    assert {k: [(t.value, t.type, t.lang) for t in v] for k, v in got[1].bindings.items()} == {
        "x": [("urn:a", "uri", None), ("b", "literal", None), ("urn:a", "uri", None)], "y": [("c", "literal", "en")]}
    assert got[1]["limit"] == 5 and got[2].bindings == {} and got[2].default_graphs == [] and got[3].query is None


def test_routes(spark):
    df = spark.createDataFrame([("query", "streamed"), ("query", "mapped"), ("update", None), ("construct", None), ("x", None)], "kind string, query_type string")
    assert [r[0] for r in df.select(RQ.route()).collect()] == ["query.streamed", "query.mapped", "update", "construct", None]


@pytest.mark.parametrize(
    "address, parts, url",
    [
        ("store7", ("http", "store7", 80, ""), "http://store7"),
        ("https://a.shop.example", ("https", "a.shop.example", 443, ""), None),
        ("https://a.shop.example:8443", ("https", "a.shop.example", 8443, ""), None),
        ("https://a-b.shop.example/ds/query", ("https", "a-b.shop.example", 443, "/ds/query"), None),
        ("https://a.shop.example:65000/ds/query", ("https", "a.shop.example", 65000, "/ds/query"), None),
        ("http://h:80/x", ("http", "h", 80, "/x"), "http://h/x"),
        ("not an address", ("http", "localhost", 80, ""), "http://localhost"),
    ],
)
def test_endpoints(spark, address, parts, url):
    df = spark.createDataFrame([(address,)], "a string").select(RQ.parse_endpoint("a").alias("e"))
    at = [F.col(f"e.{c}") for c in ("protocol", "host", "port", "path")]
    got = df.select("e.*", RQ.endpoint_url(*at).alias("url")).first()
    assert tuple(got)[:4] == parts and got.url == (url or address)
