import glob
import gzip
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrille.functions import terms
from quadrille.schema import QUAD_COLS, RDF_LANGSTRING, RDF_TYPE, XSD
from quadrille.sources import jsonld, rdf_lines, turtle, writers

from .data import ALT, COMMENT, LABEL, MODEL, as_set, frame, res, rows, text, uri

LINES = r'''<urn:a> <urn:p> "x\n\"y\" \\ é \U0001F600 \\U0001F600 \'q\'" .
# comment
_:b1 <urn:p> <urn:o> <urn:g> . # say "hi"
<urn:a>	<urn:p>	"1"^^<http://www.w3.org/2001/XMLSchema#int> <urn:g>.
<urn:a> <urn:p> "hé"@fr-BE . # "c"
<urn:a> <urn:p> "bad\q" .
garbage

<urn:a\u0020b> <urn:p> "x" .
'''


def test_nquads_lines(spark, tmp_path):
    (tmp_path / "a.nq").write_text(LINES)
    got = rdf_lines.read_nquads(spark, str(tmp_path / "a.nq"), "PERMISSIVE").collect()
    good = [r for r in got if r._corrupt_record is None]
    assert [r._corrupt_record for r in got if r._corrupt_record] == ['<urn:a> <urn:p> "bad\\q" .', "garbage"]
    assert [(r.g, r.o, r.o_datatype, r.o_lang) for r in good] == [
        (None, "x\n\"y\" \\ é 😀 \\U0001F600 'q'", XSD + "string", None),
        ("urn:g", "urn:o", None, None),
        ("urn:g", "1", XSD + "int", None),
        (None, "hé", RDF_LANGSTRING, "fr-BE"),
        (None, "x", XSD + "string", None),
    ]
    assert good[1].s_type == "bnode" and good[1].s.endswith(".b1") and good[4].s == "urn:a b"
    assert rdf_lines.read_nquads(spark, str(tmp_path / "a.nq"), "DROPMALFORMED").count() == 5
    assert rdf_lines.read_ntriples(spark, str(tmp_path / "a.nq"), "DROPMALFORMED").count() == 3
    with pytest.raises(PySparkException):
        rdf_lines.read_nquads(spark, str(tmp_path / "a.nq")).collect()


def test_a_line_with_the_inner_separator(spark):
    lines = spark.createDataFrame([("\x01" * 6,), ('<urn:a> <urn:p> "x\x01y" .',)], "value string")
    got = rdf_lines.parse_statements(lines).collect()
    assert [r.o for r in got] == [None, "x\x01y"]


def test_long_literal_with_many_escapes(spark, tmp_path):
    (tmp_path / "a.nt").write_text('<urn:a> <urn:p> "' + "ab\\n" * 100_000 + '" .\n')
    assert rdf_lines.read_ntriples(spark, str(tmp_path)).select(F.length("o")).first()[0] == 300_000


def test_blank_nodes_belong_to_their_file(spark, tmp_path):
    for name in ("a.nt", "b.nt"):
        (tmp_path / name).write_text("_:x <urn:p> _:x .\n")
    got = rdf_lines.read_ntriples(spark, str(tmp_path)).collect()
    assert len({r.s for r in got}) == 2 and all(r.s == r.o for r in got)


text_values = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(text_values, min_size=1, max_size=12), iris=st.lists(text_values, min_size=1, max_size=4))
def test_nquads_round_trip(spark, values, iris):
    data = {text("urn:g", "urn:s", "urn:p", v) for v in values}
    data |= {text(None, "urn:s", "urn:p", v, RDF_LANGSTRING, "en") for v in values}
    data |= {uri("urn:g", "urn:s", "urn:p", "urn:" + i) for i in iris if not any(ord(c) < 32 for c in i)}
    lines = writers.to_nquads(frame(spark, sorted(data, key=str)))
    assert as_set(rdf_lines.parse_statements(lines, mode="FAILFAST").select(*QUAD_COLS)) == data


def _plain():
    """Names and notes without a graph."""
    return {(None, *r[1:]) for r in rows() if r[3] in (LABEL, COMMENT)}


def test_three_formats_give_the_same_triples(spark, tmp_path):
    nt, ttl, docs = [], [], []
    for i in range(9):
        labels = [f"Lamp {i}"] + ([f"Old lamp {i}"] if i < 4 else [])
        nt += [f'<{res(i)}> <{LABEL}> "{v}" .' for v in labels] + [f'<{res(i)}> <{COMMENT}> "Needs {i} bulbs" .']
        ttl.append(f'<{res(i)}> <{LABEL}> ' + " , ".join(f'"{v}"' for v in labels) + f' ;\n\t<{COMMENT}> "Needs {i} bulbs" .\n')
        docs.append({"@id": res(i), COMMENT: [{"@value": f"Needs {i} bulbs"}], LABEL: [{"@value": v} for v in labels]})
    for name, body in (("nt", "\n".join(nt)), ("ttl", "\n".join(ttl)), ("json", json.dumps(docs, indent=2)), ("ndjson", "\n".join(map(json.dumps, docs)))):
        (tmp_path / f"lamps.{name}").write_text(body)
    at = lambda name: str(tmp_path / f"lamps.{name}")
    for df in (
        rdf_lines.read_ntriples(spark, at("nt")), turtle.read_turtle(spark, at("ttl")),
        jsonld.read_jsonld(spark, at("json")), jsonld.read_jsonld(spark, at("ndjson"), layout="lines"),
    ):
        got = [tuple(r) for r in df.collect()]
        assert len(got) == 22 and set(got) == _plain()


TTL = '''@prefix ex: <http://ex/> .
PREFIX foaf: <http://foaf/>
ex:a a foaf:Person ; foaf:name "Al \\"x\\"" , "Bo"@en ; foaf:age 42 , 4.5 , 1e3 , true ; foaf:d "2"^^ex:int .
@prefix ex: <http://ex2/> .
ex:b foaf:knows _:x
  , ex:c.d ,
 <urn:z#q> . # end
'''


def turtle_parts(spark, files, width):
    """Lines of files in parts of so many lines, as a reader would give them."""
    rows = [(t, name, i // width) for name, text in files.items() for i, t in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "value string, file string, part bigint").coalesce(1)


@pytest.mark.parametrize("width", [1, 2, 20_000])
def test_turtle(spark, width):
    lines = turtle_parts(spark, {"a": TTL, "b": "@prefix ex: <http://other/> .\nex:s ex:p ex:o .\n"}, width)
    got = {(r.s, r.p, r.o if r.o_type != "bnode" else "_", r.o_datatype, r.o_lang) for r in turtle.parse_turtle(lines).collect()}
    f, a, b = "http://foaf/", "http://ex/a", "http://ex2/b"
    assert got == {
        (a, "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", f + "Person", None, None),
        (a, f + "name", 'Al "x"', XSD + "string", None), (a, f + "name", "Bo", RDF_LANGSTRING, "en"),
        (a, f + "age", "42", XSD + "integer", None), (a, f + "age", "4.5", XSD + "decimal", None),
        (a, f + "age", "1e3", XSD + "double", None), (a, f + "age", "true", XSD + "boolean", None),
        (a, f + "d", "2", "http://ex/int", None),
        (b, f + "knows", "_", None, None), (b, f + "knows", "http://ex2/c.d", None, None),
        (b, f + "knows", "urn:z#q", None, None),
        ("http://other/s", "http://other/p", "http://other/o", None, None),
    }


BASED = """@base <http://ex/dir/> .
<a> <p> <#f> , <../up> ;
    <q>
"x"
  ^^
<urn:dt> .
@prefix : <http://ex/p#> . :s :p 4 . :s :p "\\u00e9\\t"@fr.
:t :p\\.q :o;.
<bad> <p> .
:s :p "\\U00110000" .
no:ns :p :o .
:u :p 1 2 .
BASE <urn:x:>
<#y> a <urn:Z> .
:open :p :o
"""


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_turtle_bases_terms_over_lines_and_open_ends(spark, width):
    got = turtle.parse_turtle(turtle_parts(spark, {"f": BASED}, width), "PERMISSIVE").collect()
    a, s, p = "http://ex/dir/a", "http://ex/p#s", "http://ex/dir/p"
    assert {(r.s, r.p, r.o, r.o_datatype, r.o_lang) for r in got if r._corrupt_record is None} == {
        (a, p, "http://ex/dir/#f", None, None), (a, p, "http://ex/up", None, None), (a, "http://ex/dir/q", "x", "urn:dt", None),
        (s, "http://ex/p#p", "4", XSD + "integer", None), (s, "http://ex/p#p", "é\t", RDF_LANGSTRING, "fr"),
        ("http://ex/p#t", "http://ex/p#p.q", "http://ex/p#o", None, None), ("urn:x:#y", RDF_TYPE, "urn:Z", None, None),
    }
    assert sorted(r._corrupt_record for r in got if r._corrupt_record) == [
        ':open :p :o', ':s :p "\\U00110000"', ":u :p 1 2", "<bad> <p>", "no:ns :p :o"]


def test_turtle_says_what_it_can_not_read(spark, tmp_path):
    (tmp_path / "a.ttl").write_text("<urn:a> <urn:p> [ <urn:q> 1 ] .\nun:known <urn:p> <urn:o> .\n<urn:b> <urn:p> <urn:o> .\n")
    got = turtle.read_turtle(spark, str(tmp_path), "PERMISSIVE")
    assert [r.s for r in got.where("_corrupt_record IS NULL").collect()] == ["urn:b"]
    assert got.where("_corrupt_record IS NOT NULL").count() > 0
    assert turtle.read_turtle(spark, str(tmp_path), "DROPMALFORMED").count() == 1
    with pytest.raises(PySparkException):
        turtle.read_turtle(spark, str(tmp_path)).collect()


def test_jsonld_terms_graphs_and_errors(spark, tmp_path):
    node = {"@id": "_:n", "@type": ["urn:T"], "urn:p": [{"@value": "x", "@language": "en"}, {"@id": "urn:o"}, {"@value": "1", "@type": XSD + "int"}]}
    (tmp_path / "a.json").write_text(json.dumps([{"@id": "urn:g", "@graph": [node]}]))
    local = lambda v, t: v.split(".")[-1] if t == "bnode" else v
    got = {(r.g, local(r.s, r.s_type), r.s_type, r.o, r.o_type, r.o_datatype, r.o_lang) for r in jsonld.read_jsonld(spark, str(tmp_path)).collect()}
    head = ("urn:g", "n", "bnode")
    assert got == {
        (*head, "urn:T", "uri", None, None), (*head, "x", "literal", RDF_LANGSTRING, "en"),
        (*head, "urn:o", "uri", None, None), (*head, "1", "literal", XSD + "int", None),
    }
    (tmp_path / "b.json").write_text("{ not json")
    assert jsonld.read_jsonld(spark, str(tmp_path), mode="PERMISSIVE").where("_corrupt_record IS NOT NULL").count() == 1
    assert jsonld.read_jsonld(spark, str(tmp_path), mode="DROPMALFORMED").count() == 4
    for wanted in (lambda d: d, lambda d: d.select("p"), lambda d: d.groupBy("g").count()):
        with pytest.raises(PySparkException):
            wanted(jsonld.read_jsonld(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("layout", ["document", "lines"])
def test_jsonld_loses_nothing(spark, tmp_path, layout):
    value = lambda v: [{"@value": v}]
    inner = {"@type": ["urn:In"], "urn:deep": [{"urn:n": value(5)}]}
    node = {"@id": "urn:a", "urn:in": [inner], "urn:v": [*value(True), *value(2.5), *value(-7), *value("5"), *value('"@value": 5}')]}
    graph = {"@id": "urn:g", "urn:note": value("own"), "@graph": [{"@id": "_:b0", "urn:p": [{"@id": "_:b1"}]}]}
    other = {"@id": "_:b0", "urn:p": value("x")}
    files = [[node, graph], [other]]
    for i, nodes in enumerate(files):
        body = json.dumps(nodes) if layout == "document" else "\n".join(map(json.dumps, nodes))
        (tmp_path / f"{i}.json").write_text(body)
    got = [tuple(r) for r in jsonld.read_jsonld(spark, str(tmp_path), layout).collect()]
    assert len(got) == 12 and len(set(got)) == 12
    by_p = {}
    for g, s, st, p, o, ot, dtype, _ in got:
        by_p.setdefault(p, []).append((g, s, st, o, ot, dtype))
    assert sorted((o, d) for *_, o, _, d in by_p["urn:v"]) == sorted(
        [("true", XSD + "boolean"), ("2.5E0", XSD + "double"), ("-7", XSD + "integer"), ("5", XSD + "string"), ('"@value": 5}', XSD + "string")])
    ((_, _, _, first, kind, _),) = by_p["urn:in"]
    assert kind == "bnode" and [(s, o) for _, s, _, o, _, _ in by_p[RDF_TYPE]] == [(first, "urn:In")]
    ((_, s, _, second, _, _),) = by_p["urn:deep"]
    assert s == first and [(s, o, d) for _, s, _, o, _, d in by_p["urn:n"]] == [(second, "5", XSD + "integer")]
    assert [(g, s, o) for g, s, _, o, _, _ in by_p["urn:note"]] == [(None, "urn:g", "own")]
    # The blank nodes of two files are two nodes.
    assert len({s for _, s, *_ in by_p["urn:p"]}) == 2 and {g for g, *_ in by_p["urn:p"]} == {"urn:g", None}


@pytest.mark.parametrize("buckets", [4, 16, 256])
def test_store_round_trip_and_pruning(spark, tmp_path, buckets):
    data = frame(spark, rows() + [uri(None, "urn:s", "urn:p", "urn:o")])
    path = str(tmp_path / "quads")
    writers.write_quads(data.unionByName(data), path, buckets=buckets)
    assert writers.read_quads(spark, path).count() == 25
    assert writers.read_quads(spark, path, [ALT, None]).count() == 6
    one = writers.read_quads(spark, path, [MODEL])
    assert one.count() == 19
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g_" in plan or "PartitionFilters: [(g_" in plan


def many_graphs(spark, first, n, each):
    """``each`` statements in every one of ``n`` graphs, and as many outside."""
    no = F.lit(None).cast("string")
    graph = F.when(F.col("id") % n > 0, F.concat(F.lit("urn:g"), F.col("id") % n + first))
    return spark.range(n * each).select(
        graph.alias("g"), F.concat(F.lit("urn:s"), F.col("id")).alias("s"), F.lit("uri").alias("s_type"), F.lit("urn:p").alias("p"),
        F.lit("urn:o").alias("o"), F.lit("uri").alias("o_type"), no.alias("o_datatype"), no.alias("o_lang"))


def files_of(df):
    return {r[0].split("/g_depth=")[1].rsplit("/", 1)[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_buckets_split_as_they_grow(spark, tmp_path):
    path = str(tmp_path / "quads")
    writers.write_quads(many_graphs(spark, 0, 40, 10), path, buckets=2, bucket_rows=60)
    layout = writers.Layout(spark, path)
    assert max(r["n_rows"] for r in layout.rows) <= 60 and sum(r["n_rows"] for r in layout.rows) == 400
    assert len(set(layout.slots())) > 1 and sum(r["n_graphs"] for r in layout.rows) == 40
    # What is there already is not added again; a graph that outgrows a bucket alone stays in one.
    writers.append_quads(many_graphs(spark, 0, 40, 12).unionByName(many_graphs(spark, 500, 3, 90)), path, bucket_rows=60)
    stored = writers.read_quads(spark, path)
    want = many_graphs(spark, 0, 40, 12).unionByName(many_graphs(spark, 500, 3, 90)).select(*QUAD_COLS).distinct()
    assert stored.count() == want.count() and stored.exceptAll(want).isEmpty()
    layout = writers.Layout(spark, path)
    assert layout.version == 1 and all(r["n_rows"] <= 60 or r["n_cells"] == 1 for r in layout.rows)
    for g in ("urn:g7", "urn:g501", None):
        one = writers.read_quads(spark, path, [g])
        assert one.count() == want.where(F.col("g").eqNullSafe(F.lit(g))).count() and len(files_of(one)) == 1
    assert writers.read_quads(spark, path, ["urn:none"]).count() == 0
    assert writers.read_quads(spark, path, ["urn:g7", "urn:g8", "urn:g501"]).count() == 12 + 12 + 90


def test_store_of_nothing_and_growth_from_it(spark, tmp_path):
    path = str(tmp_path / "quads")
    writers.write_quads(many_graphs(spark, 0, 5, 2).limit(0), path)
    assert writers.read_quads(spark, path).count() == 0 and writers.read_quads(spark, path, ["urn:g1"]).count() == 0
    writers.append_quads(many_graphs(spark, 0, 5, 2), path)
    assert writers.read_quads(spark, path).count() == 10 and writers.read_quads(spark, path, ["urn:g1"]).count() == 2


def test_frames(spark):
    df = spark.createDataFrame([(1, "a\nlonger\n\nb"), (2, ""), (3, "x\n")], "id int, body string")
    got = [(r.id, r.frame_no, r.frame, r.frame_error is not None) for r in rdf_lines.frame_lines(df, "body", 3).collect()]
    assert got == [(1, 0, "a", False), (1, 1, "longer", True), (1, 2, "", False), (1, 3, "b", False), (3, 0, "x", False)]


def test_content_types(spark):
    types = ["text/turtle; charset=UTF-8", "application/ld+json", "TEXT/X-NQUADS", "application/octet-stream", "text/html"]
    df = spark.createDataFrame([(t,) for t in types], "ct string")
    got = [r[0] for r in df.select(terms.rdf_format_of("ct")).collect()]
    assert got == ["TURTLE", "JSONLD", "NQUADS", "NTRIPLES", None]


def test_names(spark):
    df = spark.createDataFrame([("http://a/b#c/d",), ("plain",), ("http://a/",)], "v string")
    assert [r[0] for r in df.select(terms.local_name("v")).collect()] == ["d", "plain", ""]
    uris = ["http://ex/a#name", "http://ex/1name", "http://ex/%41bc", "mailto:abc", "http://ex/", "", "urn:x:é1"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    local = df.select("u", terms.namespace_split("u").alias("i")).collect()
    assert [u[i:] for u, i in local] == ["name", "name", "bc", "bc", "", "", "é1"]


def test_accessors(spark):
    df = spark.createDataFrame([(v,) for v in ("12", "70000", "true", "1", "t", "x:y", "99999999999", "1.5")], "v string")
    kinds = ["short", "int", "bigint", "boolean", "iri"]
    got = [tuple(str(c) if c is not None else None for c in r) for r in df.select(*[terms.as_type("v", k) for k in kinds]).collect()]
    assert got[0] == ("12", "12", "12", None, None) and got[1] == (None, "70000", "70000", None, None)
    assert got[2][3] == "True" and got[3][3] == "True" and got[4][3] is None
    assert got[5][4] == "x:y" and got[6][:3] == (None, None, "99999999999") and got[7][:3] == (None, None, None)




def test_integers_of_any_length(spark):
    long = "9" * 60
    df = spark.createDataFrame([(v,) for v in (long, "-00" + long, "+7", " 007 ", "-0", "0", "1.0", "", "x", None)], "v string")
    got = [r[0] for r in df.select(terms.as_type("v", "integer")).collect()]
    assert got == [long, "-" + long, "7", "7", "0", "0", None, None, None, None]


def test_failfast_holds_whatever_is_wanted(spark, tmp_path):
    good, bad = "<urn:a> <urn:p> \"x\" .\n", "<urn:a> <urn:p> .\n"
    for name, read in (("nt", rdf_lines.read_ntriples), ("nq", rdf_lines.read_nquads), ("ttl", turtle.read_turtle)):
        path = tmp_path / f"a.{name}"
        path.write_text(good + (bad if name != "ttl" else "un:known <urn:p> <urn:o> .\n"))
        for wanted in (lambda d: d.groupBy().count(), lambda d: d.select("p"), lambda d: d.groupBy("g").count()):
            with pytest.raises(PySparkException):
                wanted(read(spark, str(path))).collect()
        with pytest.raises(PySparkException):
            read(spark, str(path)).count()


@pytest.mark.parametrize("escape", ["\\U00110000", "\\U0000D800", "\\uDFFF", "\\uD83D\\uDE00", "\\UFFFFFFFF", "\\x"])
def test_numbers_that_are_no_characters(spark, escape):
    lines = spark.createDataFrame([(f'<urn:a> <urn:p> "{escape}" .',), (f"<urn:a{escape}> <urn:p> <urn:o> .",), ('<urn:a> <urn:p> "\\U0001F600\\u00e9" .',)], "value string")
    got = rdf_lines.parse_statements(lines)
    assert got.where("_corrupt_record IS NOT NULL").count() == 2
    assert [r.o for r in got.where("_corrupt_record IS NULL").collect()] == ["😀é"]
    assert [r[0] for r in lines.select(rdf_lines.body_is_valid(F.col("value"))).collect()] == [False, False, True]
    alone = spark.createDataFrame([(escape,)], "v string").select(terms.unescape(F.col("v"))).first()[0]
    assert alone is None


def test_a_line_is_matched_once(spark):
    """The condition on malformed lines does not compute the fields a second time."""
    lines = spark.range(2).select(F.concat(F.lit("<urn:s> <urn:p> <urn:o"), F.col("id").cast("string"), F.lit("> .")).alias("value"))
    for quads in (True, False):
        out = rdf_lines.parse_statements(lines, mode="FAILFAST", quads=quads)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(regexp_replace(") <= 2 and "Filter" in plan
        assert not any("regexp_replace" in line for line in plan.splitlines() if "raise_error" in line)
        assert {r["o"] for r in out.collect()} == {"urn:o0", "urn:o1"}


def lines_in(folder):
    opened = lambda p: gzip.open(p, "rt") if p.endswith(".gz") else open(p)
    return {p: len(opened(p).read().splitlines()) for p in glob.glob(f"{folder}/part-*")}


@pytest.mark.parametrize("quads", [True, False])
def test_compressed_lines_come_back_from_small_files(spark, tmp_path, monkeypatch, quads):
    monkeypatch.setattr(writers, "FILE_LINES", 100)
    data = frame(spark, [text("urn:g" if quads else None, f"urn:s{i}", "urn:p", f"v\n{i}") for i in range(250)]).coalesce(1)
    write, read = (writers.write_nquads, rdf_lines.read_nquads) if quads else (writers.write_ntriples, rdf_lines.read_ntriples)
    path = str(tmp_path / "lines")
    write(data, path, compression="gzip")
    files = lines_in(path)
    assert all(p.endswith(".gz") for p in files)
    assert sorted(files.values()) == [50, 100, 100]
    assert as_set(read(spark, path)) == as_set(data)


@pytest.mark.parametrize("name, folder", [("read_nquads", "nq"), ("read_ntriples", "nt")])
def test_lines_that_are_read_back_are_compressed(spark, tmp_path, monkeypatch, name, folder):
    from quadrille.plans import source_queries

    data = frame(spark, [text("urn:g", f"urn:s{i}", "urn:p", f"v{i}") for i in range(30)])
    monkeypatch.setattr(source_queries.V, "all_quads", lambda spark, sf_dir: data)
    monkeypatch.setattr(source_queries, "fresh_path", lambda spark, name: str(tmp_path / name))
    assert getattr(source_queries, name)(spark, "unused").count() == 30
    files = lines_in(tmp_path / folder)
    assert sum(files.values()) == 30 and all(p.endswith(".gz") for p in files)
