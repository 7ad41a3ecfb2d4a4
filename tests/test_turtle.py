"""Turtle in parts: strings over many lines, wherever a file is cut, and whole bodies in cells."""

import random

import pytest
from pyspark.sql import functions as F

from quadrille.schema import RDF_LANGSTRING, XSD
from quadrille.sources import turtle

from .test_formats import turtle_parts

LONG = r'''@prefix e: <urn:e:> . # not """ one
e:s e:note """A note.
<urn:a> <urn:b> <urn:c> .
@prefix e: <urn:wrong:> .
QQQ e:x e:y e:z .
say ""hi"" \\"\"" # no comment \u00e9
end"""@en , QQQx . "y" """ z
e:q e:q e:q . QQQ ; e:p "short \" # . \"\"", 'its', "" , """""" .
e:t e:p <urn:x#y> .
e:u e:p e:v .
e:open e:p """never closed .
e:lost e:p e:lost .
'''.replace("QQQ", "'''")


def read(spark, text, width, mode="FAILFAST"):
    return turtle.parse_turtle(turtle_parts(spark, {"f": text}, width), mode).collect()


def test_a_statement_needs_no_line_of_its_own(spark):
    text = '@prefix e: <urn:e:>.e:a e:b e:c .e:a e:b .5,1.5.PREFIX g:<urn:g:>g:a\ng:b""@en-GB,"x"^^g:t.\n'
    assert {(r.s, r.p, r.o, r.o_datatype, r.o_lang) for r in read(spark, text, 9)} == {
        ("urn:e:a", "urn:e:b", "urn:e:c", None, None), ("urn:e:a", "urn:e:b", ".5", XSD + "decimal", None),
        ("urn:e:a", "urn:e:b", "1.5", XSD + "decimal", None), ("urn:g:a", "urn:g:b", "", RDF_LANGSTRING, "en-GB"),
        ("urn:g:a", "urn:g:b", "x", "urn:g:t", None)}


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_what_a_string_holds_is_never_a_statement(spark, width):
    got = read(spark, LONG, width, "PERMISSIVE")
    note = "A note.\n<urn:a> <urn:b> <urn:c> .\n@prefix e: <urn:wrong:> .\n''' e:x e:y e:z .\nsay \"\"hi\"\" \\\"\"\" # no comment é\nend"
    e = "urn:e:"
    assert {(r.s, r.p, r.o, r.o_lang) for r in got if r._corrupt_record is None} == {
        (e + "s", e + "note", note, "en"), (e + "s", e + "note", 'x . "y" """ z\ne:q e:q e:q . ', None), (e + "s", e + "p", 'short " # . ""', None),
        (e + "s", e + "p", "its", None), (e + "s", e + "p", "", None), (e + "t", e + "p", "urn:x#y", None), (e + "u", e + "p", e + "v", None)}
    bad = [r._corrupt_record for r in got if r._corrupt_record is not None]
    assert len(bad) == 1 and bad[0].startswith("e:open e:p") and "e:lost" in bad[0]


def some_file(rng):
    pieces = ['"""a\nb . c\n"""', "'''d\n# e .\n'''", '"f . g"', "p:h", "<urn:i#j.k>", "1.5", '"l"@en', '# m . """\n p:n', '"""o"""^^p:q', "_:r.s"]
    text = "@prefix p: <urn:p0:> .\n"
    for k in range(12):
        text += f"p:s{k} p:v " + " ,\n ".join(rng.choices(pieces, k=rng.randint(1, 3))) + rng.choice([" .\n", ".\n", "\n.\n\n", " ;\n p:w true . "])
        text += rng.choice(["", f"@prefix p: <urn:p{k}:> .\n", f"PREFIX p: <urn:p{k}:>\n", "bad bad . ", "# p:x p:y p:z .\n"])
    return text


def test_parts_of_any_width_and_cells_give_the_same(spark):
    rng = random.Random(11)
    files = {f"f{i}": some_file(rng) for i in range(6)}
    plain = lambda r: str((*r[:1], r[1] if r[2] == "uri" else "_", *r[2:4], "_" if r[5] == "bnode" else r[4], *r[5:8]))
    results = []
    for width in (1, 4, 1000):
        rows = turtle.parse_turtle(turtle_parts(spark, files, width), "PERMISSIVE").collect()
        results.append((sorted(plain(r) for r in rows if r[8] is None), sorted(r[8] for r in rows if r[8])))
    assert results[0] == results[1] == results[2] and len(results[0][0]) > 100
    cells = spark.createDataFrame(list(files.items()), "name string, text string")
    whole = turtle.parse_cells(cells, "text", F.lit("x."), "q")
    # A document with one bad statement is none; without those they are all there.
    assert {r["name"]: r["q"] is None for r in whole.collect()} == {n: "bad bad" in t for n, t in files.items()}
    mended = cells.withColumn("text", F.replace("text", F.lit("bad bad . "), F.lit("")))
    got = turtle.parse_cells(mended, "text", F.lit("x."), "q").select(F.explode("q").alias("q")).select("q.*").collect()
    assert sorted(map(plain, got)) == results[0][0]


def test_cells_resolve_by_themselves(spark):
    rows = [(1, "@base <http://b/d/> . @prefix p: <x#> . <a> p:b <../c> ."), (2, "p:a p:b p:c ."), (3, ""), (4, None), (5, "# nothing\n"),
            (6, "@prefix p: <urn:p:> . p:a p:b p:c . @prefix p: <urn:q:> . p:a p:b _:n"), (7, "@prefix p: <urn:p:> . p:a p:b _:n . @prefix p: <urn:q:> . p:a a 1 .")]
    got = turtle.parse_cells(spark.createDataFrame(rows, "id int, t string"), "t", F.concat(F.col("id").cast("string"), F.lit(".")), "q")
    found = {r["id"]: r["q"] and [(q.s, q.p, q.o) for q in r["q"]] for r in got.collect()}
    assert found == {
        1: [("http://b/d/a", "http://b/d/x#b", "http://b/c")], 2: None, 3: [], 4: None, 5: [], 6: None,
        7: [("urn:p:a", "urn:p:b", "7.n"), ("urn:q:a", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "1")]}


def test_plain_statements_are_read_without_the_whole_grammar(spark):
    """Both ways give the same triples, and statements such as those of large files take the short one."""
    text = ('@prefix p: <urn:p:> .\nPREFIX : <urn:d:>\nprefix x: <http://www.w3.org/2001/XMLSchema#>\n'
            '<urn:a:1> a p:t ; # note\n p:n "it\'s \\"x\\"\\n", "y"@en-GB , "1"^^x:int;; p:m 1.5, -2, 1e3, true ;\n :o <urn:o#p>, _:b .\n'
            '_:b p:n "" ; p:v :, "a"^^<urn:t>.p:q p:r p:s .\n')
    rare = ('<rel> p:a p:b .\n', 'p:a p:b unknown:c .\n', "p:a p:b 'single' .\n", 'p:a p:b """long""" .\n', 'p:a p:b "\\u0041" .\n', 'p:a p:b "x" @en .\n',
            'p:a _:v p:b .\n', 'p:a p:b a .\n', 'p:a p:b .\n', 'p:a p:b "x"^^ p:c .\n', 'p:a\\-b p:b p:c .\n', 'p:a p:b "x\x02y\x01z" .\n', 'p:a ; p:b p:c .\n')
    statements = spark.createDataFrame([(s,) for s in (text.split("XMLSchema#>\n")[1].split(".p:q")[0].rsplit(".\n", 1)[0] + ".", *rare)], "statement string")
    names = F.create_map(*(F.lit(x) for x in ("p:", "urn:p:", ":", "urn:d:", "x:", XSD)))
    place = lambda n: F.struct(F.lit(0).alias("part"), F.lit(n).alias("at"))
    cut = statements.select("statement", F.lit(True).alias("ends"), place(2).alias("place"), place(1).alias("last"), names.alias("names"))
    found = {r["statement"]: r["rows"] for r in turtle._plain_rows(cut).select("statement", "rows").collect()}
    assert {s for s, rows in found.items() if rows is None} == set(rare) and max(len(rows or []) for rows in found.values()) == 10

    def parsed(doc):
        rows = turtle.parse_turtle(turtle_parts(spark, {"f": doc}, 1000), "PERMISSIVE").collect()
        return sorted(str((*r[:4], *("_" if k == "bnode" else v for k, v in ((r[5], r[4]),)), *r[5:])) for r in rows if r[2] == "uri" or r[1] is None)

    # In front of the last declaration all is left to the whole grammar.
    late = "@prefix last: <urn:last:> .\n"
    whole = text + "".join(rare)
    assert parsed(whole) == parsed(whole + late) and len(parsed(whole)) > 14
