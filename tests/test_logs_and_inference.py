import math
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quadrille.operators import graph_log, reasoning, responses, scans, search, solutions
from quadrille.schema import RDF_TYPE, RDFS, XSD_STRING

from .data import as_set, frame, text, uri

OPS = "seq bigint, op string, g string"
PAYLOAD = "seq bigint, s string, s_type string, p string, o string, o_type string, o_datatype string, o_lang string"


def fold(ops, payload):
    """The log applied one operation at a time."""
    state, there, outcomes = {}, {None}, []
    for seq, op, g in sorted(ops):
        adds = {r[1:] for r in payload if r[0] == seq}
        ok = op in ("PUT", "POST") or g in there
        if op == "PUT":
            state[g] = adds
        elif op == "POST":
            state[g] = state.get(g, set()) | adds
        elif op == "DELETE":
            state.pop(g, None)
        if op in ("PUT", "POST"):
            there.add(g)
        elif op == "DELETE" and g is not None:
            there.discard(g)
        outcomes.append((seq, ok, len(state.get(g, set()))))
    return {(g, *t) for g, ts in state.items() for t in ts}, outcomes


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_is_a_fold(spark, seed):
    rnd = random.Random(seed)
    # One graph has most of the log.
    ops = [(i, rnd.choice(["PUT", "POST", "POST", "DELETE", "GET"]), rnd.choice(["hot"] * 6 + ["a", "b", None])) for i in range(300)]
    payload = [
        (seq, "s", "uri", "p", str(rnd.randrange(6)), "literal", XSD_STRING, None)
        for seq, op, _ in ops if op in ("PUT", "POST") for _ in range(rnd.randrange(3))
    ]
    state, outcomes = fold(ops, payload)
    o, p = spark.createDataFrame(ops, OPS), spark.createDataFrame(payload, PAYLOAD)
    assert as_set(graph_log.graph_log_replay(o, p)) == state
    got = graph_log.graph_log_outcomes(o, p, block_width=7).orderBy("seq").select("seq", "success", "size_after")
    assert [tuple(r) for r in got.collect()] == outcomes


def test_running_equals_a_window(spark):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", None]), i, rnd.choice([None, rnd.randrange(100)])) for i in range(500)]
    df = spark.createDataFrame(data, "k string, pos bigint, v bigint")
    got = scans.running(
        df, ["k"], ["pos"], scans.block_of("pos", 13),
        {"total": ("sum", F.col("v")), "top": ("max_before", F.col("v"))},
    )
    expected, seen = [], {}
    for k, pos, v in data:
        before = seen.setdefault(k, [])
        top = max(before, default=None)
        if v is not None:
            before.append(v)
        expected.append((k, pos, v, sum(before) if before else None, top))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected


@pytest.mark.parametrize("n, step", [(4, 4), (4, 2), (3, 1), (2, 5)])
def test_count_windows(spark, n, step):
    data = list(range(11))
    expected, k = {}, 0
    while k * step < len(data) and (k == 0 or (k - 1) * step + n < len(data) or step >= n):
        expected[k] = data[k * step : k * step + n]
        k += 1
    df = spark.createDataFrame([("x", i) for i in data], "k string, pos bigint")
    out = scans.count_windows(df, ["k"], "pos", n, step, block_width=3)
    got = {}
    for r in out.orderBy("window", "window_pos").collect():
        got.setdefault(r.window, []).append(r.pos)
    if step > n:  # elements between windows belong to none
        got = {w: v for w, v in got.items() if v}
    assert got == {w: v for w, v in expected.items() if v}


# --- responses --------------------------------------------------------------------------------

RESPONSES = "request_id bigint, status int, content_type string, body string, transport_error string"


def test_update_rules(spark):
    rows = [
        (1, 200, "text/boolean", "TRUE", None), (2, 200, "text/boolean; charset=UTF-8", "false", None),
        (3, 200, "text/boolean", "maybe", None), (4, 200, "text/plain", "", None), (5, 204, None, "", None),
        (6, None, None, None, "reset"),
    ]
    got = responses.decode_update(spark.createDataFrame(rows, RESPONSES)).orderBy("request_id").collect()
    assert [r.success for r in got] == [True, False, False, True, False, False]
    assert [r.error is None for r in got] == [True, True, False, True, False, False]


def test_select_rules(spark):
    js = "application/sparql-results+json"
    rows = [
        (1, 200, js, '{"head":{"vars":["a"]},"results":{"bindings":[{"a":{"type":"literal","value":"x","xml:lang":"en"}},{}]}}', None),
        (2, 200, js, '{"head":{"vars":["a","b"]},"results":{"bindings":[]}}', None),
        (3, 200, js, '{"head":{},"boolean":true}', None), (4, 200, "text/html", "<p>" + "x" * 2000, None),
        (5, 500, js, '{"head":{"vars":[]},"results":{"bindings":[]}}', None), (6, None, None, None, "reset"),
        (7, 200, js, '{"head":{"vars":["a"]},"results":{"bindings":[{"a":{"type":"uri"}}]}}', None),
    ]
    df = spark.createDataFrame(rows, RESPONSES)
    decoded = responses.decode_select(df)
    got = decoded.orderBy("request_id").collect()
    assert [r.success for r in got] == [True, True, False, False, False, False, False]
    assert got[2].error == got[6].error == "body is no complete results document" and got[5].error == "no response"
    assert got[3].error == "content type is not that of results: text/html" and got[3].body == "<p>" + "x" * 2000
    found = [(r.request_id, r.row_no, r.a, r.a_lang) for r in responses.select_solutions(decoded, ["a"]).collect()]
    assert sorted(found) == [(1, 0, "x", "en"), (1, 1, None, None)]
    with pytest.raises(PySparkException):
        solutions.read_results_json(df, ["a"], mode="FAILFAST").collect()
    assert solutions.read_results_json(df.where("request_id < 3"), ["a"], mode="FAILFAST").count() == 2


def test_graph_rules(spark):
    nt = "application/n-triples"
    good = "<urn:s> <urn:p> <urn:o> .\n"
    rows = [
        (1, 200, nt, good + good, None), (2, 200, nt, good + "broken\n", None), (3, 204, None, "", None),
        (4, 404, "text/plain", "none", None), (5, 418, None, "", None), (6, None, None, None, "reset"),
        (7, 200, "application/octet-stream", good, None),
    ]
    df = spark.createDataFrame(rows, RESPONSES)
    got = [(r.request_id, r.success, r.n) for r in responses.graph_outcomes(df).orderBy("request_id").collect()]
    assert got == [(1, True, 1), (2, True, None), (3, True, None), (4, False, None), (5, None, None), (7, True, 1)]
    with pytest.raises(PySparkException):
        responses.decode_graph(df.where("request_id = 5"), "FAILFAST").collect()
    with pytest.raises(PySparkException):
        responses.decode_graph(df.where("request_id = 6"), "FAILFAST").collect()


def test_running_concat_prepends(spark):
    df = spark.createDataFrame([(1, 0, ""), (1, 1, "a"), (1, 2, "b")], "request_id int, seq int, line string")
    assert [(r.seq, r.text) for r in responses.running_concat(df).orderBy("seq").collect()] == [(1, "a"), (2, "ba")]


def test_mapping(spark):
    df = spark.createDataFrame([("urn:x", "urn:y#Bob", "7"), (None, "no colon", None)], "a string, b string, c string")
    got = solutions.map_solutions(df, [("id", "a", "iri"), ("name", "b", "local_name"), ("n", "c", "int")])
    assert [tuple(r) for r in got.collect()] == [("urn:x", "Bob", 7), (None, "no colon", None)]
    assert solutions.map_string_field(df, "b").count() == 2
    for variable in ("a", "b"):
        with pytest.raises(PySparkException):
            solutions.map_iri_field(df, variable).collect()


# --- inference and search ---------------------------------------------------------------------


def rdfs_by_hand(triples):
    sub_c, sub_p, dom, rng = (RDFS + x for x in ("subClassOf", "subPropertyOf", "domain", "range"))
    known = set(triples)
    while True:
        new = set()
        for s, p, o in known:
            for s2, p2, o2 in known:
                if p2 == sub_p and s2 == p:
                    new.add((s, o2, o))
                if p2 == dom and s2 == p:
                    new.add((s, RDF_TYPE, o2))
                if p2 == rng and s2 == p:
                    new.add((o, RDF_TYPE, o2))
                if p == RDF_TYPE and p2 == sub_c and o == s2:
                    new.add((s, RDF_TYPE, o2))
                if p == p2 and p in (sub_c, sub_p) and o == s2:
                    new.add((s, p, o2))
        if new <= known:
            return known
        known |= new


BASE = [
    ("A", RDFS + "subClassOf", "B"), ("B", RDFS + "subClassOf", "C"), ("C", RDFS + "subClassOf", "B"),
    ("p", RDFS + "subPropertyOf", "q"), ("q", RDFS + "subPropertyOf", "r"), ("r", RDFS + "domain", "A"),
    ("q", RDFS + "range", "D"), ("x", "p", "y"), ("z", RDF_TYPE, "A"),
]


@pytest.mark.parametrize(
    "more", [[], [("isa", RDFS + "subPropertyOf", RDF_TYPE), ("w", "isa", "B"), (RDF_TYPE, RDFS + "domain", "Thing")]]
)
def test_rdfs_rules(spark, more):
    triples = BASE + more
    got = reasoning.rdfs_closure(frame(spark, [uri("g", *t) for t in triples]))
    assert {(r.s, r.p, r.o) for r in got.collect()} == rdfs_by_hand(triples)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "sub int, sup int")
    assert reasoning.transitive_closure(edges).count() == 20 * 21 // 2


def test_search_scores(spark):
    docs = ["red fox", "the quick red fox, RED!", "blue whale", "fox fox fox", "le café", "red fox"]
    data = [text("g", f"s{i}", "p", d) for i, d in enumerate(docs)] + [uri("g", "s9", "p", "red"), text(None, "s8", "p", "red only here")]
    distinct = sorted(set(docs))
    toks = [re.findall(r"\w+", d.lower()) for d in distinct]
    avg = sum(map(len, toks)) / len(toks)
    expected = {}
    for d, w in zip(distinct, toks):
        score = 0.0
        for t in ("red", "fox"):
            df = sum(t in x for x in toks)
            idf = math.log(1 + (len(toks) - df + 0.5) / (df + 0.5))
            score += idf * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / avg))
        if score:
            expected[d] = round(score, 9)
    quads = frame(spark, data)
    got = search.topk_text(quads, "Red fox").collect()
    assert {r.value: round(r.score, 9) for r in got} == expected
    assert [r.value for r in got] == sorted(expected, key=lambda d: (-expected[d], d))
    best = search.search_construct(quads, "red fox", limit=1)
    assert best.count() == 1
    assert search.search_construct(quads, "red fox").count() == 4
    assert search.search_construct(quads, "*", limit=3).count() == 3


def test_rounds_join_and_write_only_what_is_new(spark, monkeypatch):
    """A vocabulary that makes vocabulary: each round's table holds the new statements alone."""
    written = []
    keep = reasoning.stage

    def counted(df, name):
        out = keep(df, name)
        if name == "rdfs-delta":
            written.append(out.count())
        return out

    monkeypatch.setattr(reasoning, "stage", counted)
    sub = reasoning.SUB_CLASS
    triples = [("urn:under", reasoning.SUB_PROPERTY, sub), ("urn:below", reasoning.SUB_PROPERTY, "urn:under"), ("urn:a", "urn:below", "urn:b"), ("urn:b", "urn:under", "urn:c"),
               ("urn:x", reasoning.RDF_TYPE, "urn:a")] + [(f"urn:y{i}", reasoning.RDF_TYPE, "urn:other") for i in range(50)]
    got = reasoning.rdfs_closure(frame(spark, [uri("g", *t) for t in triples]))
    assert {(r.s, r.p, r.o) for r in got.collect()} == rdfs_by_hand(triples)
    assert written[0] == len(triples) and written[-1] == 0 and sum(written) == got.count() and max(written[1:]) < 20


@pytest.mark.parametrize("cut", [1, 4, 9])
def test_a_closure_is_kept_up_under_inserts(spark, cut):
    triples = [("urn:a", reasoning.SUB_CLASS, "urn:b"), ("urn:x", reasoning.RDF_TYPE, "urn:a"), ("urn:q", reasoning.RDFS + "domain", "urn:d"),
               ("urn:x", "urn:p", "urn:y"), ("urn:b", reasoning.SUB_CLASS, "urn:c"), ("urn:p", reasoning.SUB_PROPERTY, "urn:q"), ("urn:z", "urn:p", "urn:x"),
               ("urn:q", reasoning.RDFS + "range", "urn:a"), ("urn:d", reasoning.SUB_CLASS, "urn:e"), ("urn:x", "urn:p", "urn:y")]
    of = lambda ts: frame(spark, [uri("g", *t) for t in ts])
    closed = reasoning.rdfs_closure(of(triples[:cut]))
    got = reasoning.extend_closure(closed, of(triples[cut - 1 :])).collect()
    assert {(r.s, r.p, r.o) for r in got} == rdfs_by_hand(triples) and len(got) == len(set(got))


def test_checks_hold_whatever_is_wanted(spark):
    """A missing value and an unknown status raise even where only the rows are counted."""
    one = spark.createDataFrame([("urn:a", "uri", None, None), (None, None, None, None)], "x string, x_type string, x_datatype string, x_lang string")
    for read in (solutions.map_iri_field, solutions.map_string_field):
        with pytest.raises(PySparkException):
            read(one, "x").count()
    answers = spark.createDataFrame(
        [(1, 999, "text/plain", "", None)], "request_id int, status int, content_type string, body string, transport_error string")
    with pytest.raises(PySparkException):
        responses.decode_graph(answers, "FAILFAST").count()
    assert responses.decode_graph(answers).count() == 1


TYPES = "request_id int, status int, content_type string, body string, transport_error string"


def test_bodies_of_four_formats(spark):
    """One bad statement makes one bad response, whatever the format; prefixes and nodes are those of the response."""
    ttl, ld = "text/turtle", "application/ld+json"
    good = '[{"@id":"_:n","urn:p":[{"@value":"x"},{"@id":"urn:o"}]}]'
    rows_ = [
        (1, 200, "application/n-triples", "<urn:s> <urn:p> <urn:o> .", None), (2, 200, ttl, "@prefix e: <urn:> .\ne:s e:p _:n , \"\"\"a .\nb\"\"\" .", None),
        (3, 200, ttl, "e:s e:p e:o .", None), (4, 200, ld, good, None), (5, 200, ld, "[{", None), (6, 200, ld, '[{"@id":"urn:s","@context":"c"}]', None),
        (7, 200, ttl, "<urn:s> <urn:p> <urn:o> . <urn:s> <urn:p> [ ] .", None), (8, 200, ld, "[]", None), (9, 200, ttl, " # nothing\n", None), (10, 500, ttl, "x", None)]
    answers = spark.createDataFrame(rows_, TYPES)
    outcomes = {r["request_id"]: (r["success"], r["n"]) for r in responses.graph_outcomes(answers).collect()}
    assert outcomes == {1: (True, 1), 2: (True, 2), 3: (True, None), 4: (True, 2), 5: (True, None), 6: (True, None), 7: (True, None), 8: (True, 0), 9: (True, 0), 10: (None, None)}
    models = {(r["request_id"], r["s"], r["o"]) for r in responses.graph_models(answers).collect()}
    assert models == {(1, "urn:s", "urn:o"), (2, "urn:s", "2.n"), (2, "urn:s", "a .\nb"), (4, "4.n", "x"), (4, "4.n", "urn:o")}
    errors = {r["request_id"]: r["error"] for r in responses.decode_construct(answers).collect()}
    assert errors == {i: "malformed body" if i in (3, 5, 6, 7) else "x" if i == 10 else None for i in range(1, 11)}
