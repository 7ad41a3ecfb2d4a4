"""Turtle: prefixes, bases, ``a``, predicate and object lists, and strings over many lines.

Texts are cut in statements, and statements in tokens, by one regular expression each; everything after that
is array expressions over the tokens. A body held in one cell is parsed inside its row (``parse_cells``).

A file is split in parts like any text, and the lines of a part in chunks. Only a string in triple quotes reaches over
the end of a line, so what a chunk means depends on where it begins: outside of any string, or within one of either
kind. How each of the three would end is a small table per chunk; a scan over these tables tells how every chunk
begins, and each is then cut once. The ends of chunks, a few lines each, are put together per statement. Declarations
are a table of changes per file, in which every name looks up the last one before its place.

Not covered, and reported in ``_corrupt_record`` with the whole statement: blank node property lists
``[ ]`` and collections ``( )``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.terms import unescape
from ..operators.scans import running
from ..schema import QUAD_COLS, RDF_LANGSTRING, RDF_TYPE, TRIPLE_COLS, XSD, XSD_STRING
from ..session import stage

# --- the grammar of tokens; possessive loops neither backtrack nor recurse, however long a text is -----------

_GAP = r"(?:\s++|#[^\n]*+)*+"
_LONG = {q: rf"{q * 3}[^{q}\\]*+(?:(?:\\.|{q}(?!{q}{q}))[^{q}\\]*+)*+{q * 3}" for q in "\"'"}
_SHORT = {q: rf"{q}(?!{q}{q})[^{q}\\\n\r]*+(?:\\[^\n\r][^{q}\\\n\r]*+)*+{q}" for q in "\"'"}
_TEXT = "|".join([*_LONG.values(), *_SHORT.values()])
_IRI = r'<[^<>"{}|^`\x00-\x20]*+>'
_LETTER = r"""[^\s<>"'#();,.\[\]\\^]"""
_NUMBER = r"[+-]?+(?:[0-9]++(?:\.[0-9]*+(?=[eE])|\.[0-9]++)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+"
# A full stop belongs to a word if the word goes on after it.
_WORD = rf"{_NUMBER}|(?:\\.|{_LETTER})(?:\\.|{_LETTER}|\.+(?=\\.|{_LETTER}))*+"
_LANG = "@([a-zA-Z]+(?:-[a-zA-Z0-9]+)*+)"
_SUFFIX = rf"(?:{_GAP}{_LANG}|{_GAP}\^\^{_GAP}({_IRI}|{_WORD}))?+"
_TOKEN = rf"(?s)#[^\n]*+|(?:{_TEXT}){_SUFFIX}|{_IRI}|{_WORD}|\S"

_OPENS = "(?!\"\"\"|''')"
_PASSED = rf"\s++|#[^\n]*+|{_TEXT}|{_IRI}|{_WORD}"
_PREFIX_NAME = r"""[^\s:<>"'#]*+:"""
# The SPARQL forms of the declarations have no full stop.
_DONE = rf"(?:{_GAP}(?i:prefix)\s{_GAP}{_PREFIX_NAME}{_GAP}{_IRI}|{_GAP}(?i:base)\s{_GAP}{_IRI}|(?:{_PASSED}|{_OPENS}[^.])*+\.)"
#: A statement; or, where none ends, all that is left.
_STATEMENT = rf"(?s)\G{_DONE}|\G.++"
_IS_DONE = rf"(?s)\A{_DONE}\z"
_LEFT_OPEN = rf"(?s)\A(?:{_PASSED}|{_OPENS}.)*+(\"\"\"|'''|)"
_CLOSES = [rf"(?s)\A[^{q}\\]*+(?:(?:\\.|{q}(?!{q}{q}))[^{q}\\]*+)*+{q * 3}" for q in "\"'"]

_DIRECTIVE = rf"(?is)\A{_GAP}@?(?:prefix\s{_GAP}({_PREFIX_NAME})|base\s){_GAP}<([^>]*+)>{_GAP}\.?\z"
_IS_DIRECTIVE = rf"(?is)\A{_GAP}@?(?:prefix|base)\s"
_BLANK = rf"(?s)\A{_GAP}\z"
_SEP = "\x01"
_LITERAL = "(?s)\\A(?:" + "|".join(
    f"{q * n}((?:[^{q}\\\\]|\\\\.|{q}(?!{q}{q}))*+){q * n}" if n == 3 else f"{q}(?!{q}{q})((?:[^{q}\\\\]|\\\\.)*+){q}"
    for n in (3, 1) for q in "\"'") + f"){_SUFFIX}\\z"
# Language, datatype, text: the text comes last, so that a separator inside it does not matter.
_LITERAL_FIELDS = f"$5{_SEP}$6{_SEP}$1$2$3$4"
_NUMBERS = {XSD + "integer": r"\A[+-]?[0-9]+\z", XSD + "decimal": r"\A[+-]?[0-9]*\.[0-9]+\z",
            XSD + "double": r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+\z"}
_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.-]*:"

_PLACE = "struct<part:bigint,chunk:bigint,at:bigint>"
_KNOWN = f"array<struct<name:string,place:{_PLACE},iri:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _find(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


# --- IRIs ---------------------------------------------------------------------------------------------------


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..``."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)

    def step(done: Column, s: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(s == ".", done).when(s == "..", up).otherwise(F.concat(done, F.array(s)))

    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    # A path that ends in dots ends in a folder.
    return F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def _resolve(iri: Column, base: Column) -> Column:
    """An IRI against a base; NULL if it is relative and there is no base."""

    def against(b: Column) -> Column:
        plain = F.substring_index(b, "#", 1)
        server = F.regexp_extract(b, r"\A([^:/?#]+:(?://[^/?#]*)?)", 1)
        path = F.substring_index(F.substr(plain, F.char_length(server) + 1), "?", 1)
        folder = F.regexp_extract(path, r"(?s)\A(.*/)", 1)
        folder = F.when((folder == "") & F.contains(server, F.lit("//")), "/").otherwise(folder)
        ref_path, ref_rest = F.regexp_extract(iri, r"(?s)\A([^?#]*)", 1), F.regexp_extract(iri, r"(?s)\A[^?#]*(.*)", 1)
        joined = F.when(iri.startswith("/"), ref_path).otherwise(F.concat(folder, ref_path))
        joined = F.when(joined.rlike(r"(?:\A|/)\.\.?(?:/|\z)"), _without_dots(joined)).otherwise(joined)
        return (
            F.when((iri == "") | iri.startswith("#"), F.concat(plain, iri))
            .when(iri.startswith("//"), F.concat(F.regexp_extract(b, r"\A([^:]+:)", 1), iri))
            .when(iri.startswith("?"), F.concat(server, path, iri))
            .otherwise(F.concat(server, joined, ref_rest))
        )

    return F.when(iri.rlike(_SCHEME), iri).when(base.isNotNull(), _let(base, against))


# --- declarations -------------------------------------------------------------------------------------------


def _declaration(statement: Column) -> Column:
    """``name, iri`` as written: the prefix with its colon, or an empty name for the base; NULL if it is none."""
    fields = F.split(F.regexp_replace(statement, _DIRECTIVE, f"$1{_SEP}$2"), _SEP, 2)
    return F.when(statement.rlike(_DIRECTIVE), F.struct(F.get(fields, F.lit(0)).alias("name"), unescape(F.get(fields, F.lit(1))).alias("iri")))


def _in_order(declared: Column) -> Column:
    """Declarations sorted by place, each IRI resolved against the base before it."""
    start = F.struct(F.lit(None).cast("string").alias("base"), F.array().cast(_KNOWN).alias("out"))

    def one(done: Column, d: Column) -> Column:
        return _let(_resolve(d["iri"], done["base"]), lambda iri: F.struct(
            F.when(d["name"] == "", iri).otherwise(done["base"]).alias("base"),
            F.concat(done["out"], F.array(F.struct(d["name"].alias("name"), d["place"].alias("place"), iri.alias("iri")))).alias("out")))

    return F.aggregate(declared, start, one, lambda done: done["out"])


def _look_up(known: Column, name: Column, place: Column) -> Column:
    """The last IRI declared for a name before a place."""
    return F.try_element_at(F.filter(known, lambda d: (d["name"] == name) & (d["place"] < place)), F.lit(-1))["iri"]


# --- statements ---------------------------------------------------------------------------------------------


def _lexical(text: Column) -> Column:
    """The characters of a string; NULL if it has an escape that is none."""
    # Quotes that need no escape here need one where the escapes are undone.
    quoted = F.regexp_replace(text, r'(?s)\G((?:[^"\\]|\\.)*+)"', r'$1\\"')
    legal = text.rlike(r"""(?s)\A(?:[^\\]|\\[tbnrf"'\\uU])*+\z""")
    return F.when(~F.contains(text, F.lit("\\")), text).when(legal, unescape(quoted))


def _resource(token: Column, known: Column, place: Column, scope: Column) -> Column:
    """``value, type`` of an IRI, a prefixed name or a blank node."""
    inside = unescape(F.substring(token, F.lit(2), F.char_length(token) - 2))
    full = _let(inside, lambda i: _resolve(i, _look_up(known, F.lit(""), place)))
    name = F.concat(F.substring_index(token, ":", 1), F.lit(":"))
    local = F.substr(token, F.char_length(name) + 1)
    local = F.when(F.contains(local, F.lit("\\")), F.regexp_replace(local, r"\\(.)", "$1")).otherwise(local)
    is_iri, is_bnode = token.startswith("<"), token.startswith("_:")
    value = (
        F.when(is_iri, F.when(token.endswith(">"), full))
        .when(is_bnode, F.when(F.char_length(token) > 2, F.concat(scope, F.substr(token, F.lit(3)))))
        .when(token.rlike(r"(?U)\A(?:\w[\w.-]*)?:"), F.concat(_look_up(known, name, place), local))
    )
    return F.struct(value.alias("value"), F.when(is_bnode, "bnode").otherwise("uri").alias("type"))


def _term(token: Column, known: Column, place: Column, scope: Column) -> Column:
    """A token and the columns of an object that it stands for; a NULL value if it is none.

    What is looked up is the token itself, or the datatype of a string: one expression for both.
    """
    none = F.lit(None).cast("string")
    number = none
    for datatype, pattern in _NUMBERS.items():
        number = F.when(token.rlike(pattern), F.lit(datatype)).otherwise(number)
    number = F.when(token.rlike(r"\A[0-9+.-]"), number)
    plain = F.when(token.isin("true", "false"), F.lit(XSD + "boolean")).otherwise(number)
    fields = F.when(token.rlike("\\A[\"']"), F.split(F.regexp_replace(token, _LITERAL, _LITERAL_FIELDS), _SEP, 3))

    def built(f: Column, kind: Column) -> Column:
        lang, datatype = F.get(f, F.lit(0)), F.get(f, F.lit(1))
        name = F.when(f.isNotNull(), F.nullif(datatype, F.lit(""))).when(kind.isNull(), token)

        def term(r: Column) -> Column:
            full = F.when(lang != "", F.lit(RDF_LANGSTRING)).when(datatype != "", F.when(r["type"] == "uri", r["value"])).otherwise(F.lit(XSD_STRING))
            string = F.when((F.size(f) == 3) & full.isNotNull(), _lexical(F.get(f, F.lit(2))))
            is_string, is_plain = f.isNotNull(), kind.isNotNull()
            return F.struct(
                token.alias("token"), F.when(is_string, string).when(is_plain, token).otherwise(r["value"]).alias("o"),
                F.when(is_string | is_plain, "literal").otherwise(r["type"]).alias("o_type"),
                F.when(is_string, full).when(is_plain, kind).alias("o_datatype"),
                F.when(is_string, F.nullif(lang, F.lit(""))).alias("o_lang"))

        return _let(_resource(name, known, place, scope), term)

    return _let(fields, lambda f: _let(plain, lambda k: built(f, k)))


def _triples(tokens: Column, known: Column, place: Column, scope: Column) -> Column:
    """The triples of a statement: its terms are cut at ``;``, and each group is a predicate and its objects.

    NULL if one of the terms or the order of tokens is wrong.
    """

    def of(terms: Column) -> Column:
        n = F.size(terms)
        cuts = F.filter(F.sequence(F.lit(1), n - 1), lambda i: F.get(terms, i)["token"] == ";")
        groups = _let(F.concat(F.array(F.lit(0)), cuts, F.array(n)), lambda b: F.transform(
            F.sequence(F.lit(1), F.size(b) - 1),
            lambda k: F.slice(terms, F.get(b, k - 1) + 2, F.get(b, k) - F.get(b, k - 1) - 1)))
        subject = F.get(terms, F.lit(0))

        def group(g: Column) -> Column:
            first = F.get(g, F.lit(0))
            verb = F.when(first["token"] == "a", F.lit(RDF_TYPE)).when(first["o_type"] == "uri", first["o"])
            return F.transform(F.filter(g, lambda _, i: i % 2 == 1), lambda o: F.struct(
                subject["o"].alias("s"), subject["o_type"].alias("s_type"), verb.alias("p"),
                *(o[c].alias(c) for c in ("o", "o_type", "o_datatype", "o_lang"))))

        is_well = lambda g: (F.size(g) % 2 == 0) & F.forall(
            F.filter(g, lambda _, i: (i % 2 == 0) & (i > 0)), lambda t: t["token"] == ",")

        def all_of(gs: Column) -> Column:
            full = F.filter(gs, lambda g: F.size(g) > 0)
            made = F.when((F.size(F.get(gs, F.lit(0))) > 0) & F.forall(full, is_well), F.flatten(F.transform(full, group)))
            whole = lambda ts: F.when(F.forall(ts, lambda t: t["s"].isNotNull() & t["p"].isNotNull() & t["o"].isNotNull()), ts)
            return _let(made, whole)

        return F.when((n >= 3) & (subject["o_type"] != "literal"), _let(groups, all_of))

    return _let(F.transform(tokens, lambda t: _term(t, known, place, scope)), of)


def _parsed(statement: Column, ends: Column, known: Column, place: Column, scope: Column) -> Column:
    """``triples``, NULL for what is no statement, and then its ``text``, of a piece that holds more than gaps.
    ``ends`` says that the piece has its end, which only the last one of a text can lack."""
    tokens = F.filter(_find(statement, _TOKEN), lambda t: ~t.startswith("#"))
    # All but the full stop of a statement that has one.
    tokens = _let(tokens, lambda t: F.when(ends & (F.element_at(t, -1) == "."), F.slice(t, F.lit(1), F.size(t) - 1)).otherwise(t))
    declared = _let(_declaration(statement), lambda d: _resolve(d["iri"], _look_up(known, F.lit(""), place)))
    nothing = F.array().cast("array<struct<" + ",".join(f"{c}:string" for c in TRIPLE_COLS) + ">>")

    def result(t: Column) -> Column:
        triples = F.when(statement.rlike(_IS_DIRECTIVE), F.when(declared.isNotNull(), nothing)).when(ends, _triples(t, known, place, scope))
        return _let(triples, lambda made: F.struct(made.alias("triples"), F.when(made.isNull(), F.array_join(t, " ")).alias("text")))

    return _let(tokens, result)


def parse_cells(texts: DataFrame, text: str, scope: Column, out: str) -> DataFrame:
    """Whole documents in a column: adds ``out``, the quads of each document as an array, NULL if a piece of it is no
    statement.

    Prefixes hold within their document, blank nodes get ``scope`` in front. All of it happens inside the row.
    """
    place = lambda i: F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("part", "chunk")), i.cast("bigint").alias("at"))
    quad = lambda t: F.struct(F.lit(None).cast("string").alias("g"), *[t[c].alias(c) for c in TRIPLE_COLS])

    def declared(pieces: Column) -> Column:
        found = F.transform(pieces, lambda p, i: _let(
            F.when(p.rlike(_IS_DIRECTIVE), _declaration(p)),
            lambda d: F.struct(d["name"].alias("name"), place(i).alias("place"), d["iri"].alias("iri"))))
        return _in_order(F.filter(found, lambda d: d["name"].isNotNull()))

    def whole(parsed: Column) -> Column:
        good = F.forall(parsed, lambda p: p["triples"].isNotNull())
        return F.when(good, F.transform(F.flatten(F.transform(parsed, lambda p: p["triples"])), quad))

    # One expression, in which every step is bound once: columns that build on each other would be computed again
    # for every condition that is pushed down.
    pieces = F.filter(_find(F.col(text), _STATEMENT), lambda p: ~p.rlike(_BLANK))
    quads = _let(pieces, lambda ps: _let(declared(ps), lambda known: _let(
        F.transform(ps, lambda p, i: _let(place(i), lambda at: _parsed(
            p, (i < F.size(ps) - 1) | p.rlike(_IS_DONE), known, at, scope))), whole)))
    return texts.withColumn(out, F.when(F.col(text).isNotNull(), quads))


# --- plain statements: one pass of one expression, for all but the rarer forms ----------------------------------

_PLAIN_GAP = r"(?:\s++|#[^\n\x01-\x03]*+)*+"
#: A word ends here for the grammar of tokens as well.
_WORD_ENDS = r"""(?=[\s;,#<"]|\.(?:\s|\z))"""
_PLAIN_IRI = r'<[A-Za-z][A-Za-z0-9+.-]*+:[^<>"{}|^`\\\x00-\x20]*+>'
_PLAIN_NAME = rf"(?:[A-Za-z][A-Za-z0-9_-]*+)?+:[A-Za-z0-9_:-]*+{_WORD_ENDS}"
_PLAIN_BNODE = rf"_:[A-Za-z0-9_-]++{_WORD_ENDS}"
_PLAIN_NUMBER = rf"(?:[+-]?+(?:[0-9]++(?:\.[0-9]++)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+|true|false){_WORD_ENDS}"
_PLAIN_TEXT = r"""[^"\\\n\r\x01-\x03]*+(?:\\[tbnrf"'\\][^"\\\n\r\x01-\x03]*+)*+"""
_PLAIN_VERB = f"{_PLAIN_IRI}|{_PLAIN_NAME}|a{_WORD_ENDS}"
_PLAIN_STRING = rf'"(?!"")({_PLAIN_TEXT})"(?:@([a-zA-Z]++(?:-[a-zA-Z0-9]++)*+){_WORD_ENDS}|\^\^({_PLAIN_IRI}|{_PLAIN_NAME})|(?!{_PLAIN_GAP}(?:@|\^)))'
#: Subject and verb, a comma, or a verb after semicolons; and then an object.
_PLAIN = (
    rf"\G(?:\A{_PLAIN_GAP}({_PLAIN_IRI}|{_PLAIN_NAME}|{_PLAIN_BNODE}){_PLAIN_GAP}({_PLAIN_VERB})|{_PLAIN_GAP},|(?!\A)(?:{_PLAIN_GAP};)++{_PLAIN_GAP}({_PLAIN_VERB}))"
    rf"{_PLAIN_GAP}(?:({_PLAIN_IRI}|{_PLAIN_NAME}|{_PLAIN_BNODE}|{_PLAIN_NUMBER})|{_PLAIN_STRING})"
)
_PLAIN_END = rf"\A(?:{_PLAIN_GAP};)*+{_PLAIN_GAP}\.\z"
# A row per object: subject, verb, object, datatype; and behind other separators language and text.
_ROW, _PART = "\x02", "\x03"
_PLAIN_ROW = _SEP.join(["$1", "$2$3", "$4", f"$7{_PART}$6{_PART}$5"]) + _ROW
_PLAIN_NAMES = r"(?:\A|[\x01\x02])((?:[A-Za-z][A-Za-z0-9_-]*+)?+:)"
_PLAIN_DIRECTIVE = rf"(?i)\A{_PLAIN_GAP}@?(?:prefix\s{_PLAIN_GAP}(?:[a-z][a-z0-9_-]*+)?+:|base\s){_PLAIN_GAP}{_PLAIN_IRI}{_PLAIN_GAP}\.?\z"


def _with_verbs(rows: Column) -> Column:
    """Rows after a comma get the verb of the row before."""
    start = F.struct(F.lit("").alias("verb"), F.array().cast("array<string>").alias("out"))

    def one(done: Column, row: Column) -> Column:
        verb = F.substring_index(F.substring_index(row, _SEP, 2), _SEP, -1)
        full = F.when(row.startswith(_SEP * 2), F.concat(F.lit(_SEP), done["verb"], F.substr(row, F.lit(2)))).otherwise(row)
        return F.struct(F.when(verb == "", done["verb"]).otherwise(verb).alias("verb"), F.concat(done["out"], F.array(full)).alias("out"))

    return F.aggregate(rows, start, one, lambda done: done["out"])


def _plain_rows(statements: DataFrame) -> DataFrame:
    """Adds ``rows``, an entry per triple, to ``statement, ends, place, last, names`` where the statement is a plain one;
    NULL where it is left to the whole grammar. ``names`` is what the names mean after the last declaration."""
    cut = statements.withColumn("_flat", F.when(F.col("ends") & F.coalesce(F.col("place") > F.col("last"), F.lit(True)),
                                                F.regexp_replace("statement", _PLAIN, _PLAIN_ROW)))
    cut = cut.withColumn("_rows", F.split("_flat", _ROW))
    used = F.regexp_extract_all("_flat", F.lit(_PLAIN_NAMES), F.lit(1))
    plain = F.element_at("_rows", -1).rlike(_PLAIN_END) & (F.size("_rows") > 1) & (F.size(F.array_except(used, F.map_keys("names"))) == 0)
    rows = F.slice("_rows", F.lit(1), F.size("_rows") - 1)
    rows = F.when(F.contains("_flat", F.lit(_ROW + _SEP * 2)), _with_verbs(rows)).otherwise(rows)
    return cut.withColumn("rows", F.when(plain, rows)).drop("_rows", "_flat")


def _plain_triple(row: Column, subject: Column, names: Column, scope: Column) -> dict[str, Column]:
    """The columns of a triple from the fields of its row."""
    def resource(token: Column) -> Column:
        name = F.concat(F.substring_index(token, ":", 1), F.lit(":"))
        return (F.when(token.startswith("<"), F.substring(token, F.lit(2), F.char_length(token) - 2))
                .when(token.startswith("_:"), F.concat(scope, F.substr(token, F.lit(3))))
                .otherwise(F.concat(F.try_element_at(names, name), F.substr(token, F.char_length(name) + 1))))

    def kind(token: Column) -> Column:
        return F.when(token.startswith("_:"), "bnode").otherwise("uri")

    field = lambda i: F.get(row, F.lit(i))
    token, literal = field(2), field(3)
    is_string = token == ""
    is_number = token.isin("true", "false") | token.rlike(r"\A[0-9+.-]")
    lang = F.substring_index(F.substring_index(literal, _PART, 2), _PART, -1)
    datatype = F.substring_index(literal, _PART, 1)
    number = F.lit(XSD + "boolean")
    for kind_of, pattern in _NUMBERS.items():
        number = F.when(token.rlike(pattern), F.lit(kind_of)).otherwise(number)
    of_string = F.when(lang != "", F.lit(RDF_LANGSTRING)).when(datatype != "", resource(datatype)).otherwise(F.lit(XSD_STRING))
    return {
        "s": resource(subject), "s_type": kind(subject),
        "p": F.when(field(1) == "a", F.lit(RDF_TYPE)).otherwise(resource(field(1))),
        "o": F.when(is_string, _lexical(F.substring_index(literal, _PART, -1))).when(is_number, token).otherwise(resource(token)),
        "o_type": F.when(is_string | is_number, "literal").otherwise(kind(token)),
        "o_datatype": F.when(is_string, of_string).when(is_number, number),
        "o_lang": F.when(is_string, F.nullif(lang, F.lit(""))),
    }


# --- files --------------------------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each batch that stand together in a part, as one text."""
    now, chunk = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        value, file, part = (batch.column(c) for c in ("value", "file", "part"))
        change = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(part[1:], part[:-1]))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(change).to_pylist()), batch.num_rows]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pc.fill_null(value, "")), "\n")
        keys, chunks = [(file[i].as_py(), part[i].as_py()) for i in cuts[:-1]], []
        for key in keys:
            chunk = chunk + 1 if key == now else 0
            now = key
            chunks.append(chunk)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array(chunks, pa.int64()), texts],
            ["file", "part", "chunk", "text"])


def _how_it_ends(text: Column) -> Column:
    """What a chunk leaves open (0 nothing, 1 a string in double quotes, 2 in single quotes), by what it begins in."""
    code = lambda t: F.when(t == '"""', 1).when(t == "'''", 2).otherwise(0)
    after = lambda t: code(F.regexp_extract(t, _LEFT_OPEN, 1))

    def within(kind: int) -> Column:
        return _let(F.regexp_extract(text, _CLOSES[kind - 1], 0), lambda c: F.when(c == "", kind).otherwise(
            after(F.substr(text, F.char_length(c) + 1))))

    quotes = F.contains(text, F.lit('"""')) | F.contains(text, F.lit("'''"))
    return F.when(quotes, F.array(after(text), within(1), within(2))).otherwise(F.array(F.lit(0), F.lit(1), F.lit(2)))


def _compose(first: Column, then: Column) -> Column:
    return F.transform(first, lambda s: F.get(then, s))


def _scan(rows: DataFrame, keys: list[str], order: str, longest: int) -> DataFrame:
    """``ends`` of all rows up to each, composed: every round takes in twice as many rows before it."""
    window = Window.partitionBy(*keys).orderBy(order)
    for i in range(math.ceil(math.log2(max(longest, 1)))):
        before = F.lag("ends", 1 << i).over(window)
        rows = rows.withColumn("ends", F.when(before.isNull(), F.col("ends")).otherwise(_compose(before, F.col("ends"))))
    return rows


def _beginnings(own: DataFrame) -> DataFrame:
    """``file, part, chunk, begins`` of the chunks that begin within a string: first within each part, then over parts."""
    longest = own.groupBy("file", "part").agg(F.count("*").alias("n"))
    longest = longest.groupBy("file").agg(F.max("n").alias("n"), F.count("*").alias("parts")).agg(F.max("n"), F.max("parts")).first()
    within = _scan(own, ["file", "part"], "chunk", longest[0] or 1)
    in_part = Window.partitionBy("file", "part").orderBy("chunk")
    within = stage(within.select("file", "part", "chunk", "ends", F.lag("ends").over(in_part).alias("before")), "turtle-ends")
    parts = within.groupBy("file", "part").agg(F.max_by("ends", "chunk").alias("ends"))
    parts = _scan(parts, ["file"], "part", longest[1] or 1)
    start = F.lag("ends").over(Window.partitionBy("file").orderBy("part"))
    parts = parts.select("file", "part", F.coalesce(F.get(start, F.lit(0)), F.lit(0)).alias("start"))
    begins = F.when(F.col("before").isNull(), F.col("start")).otherwise(F.get("before", F.col("start")))
    return within.join(parts, ["file", "part"]).select("file", "part", "chunk", begins.alias("begins")).where("begins > 0")


def _pieces(chunks: DataFrame, begin: Column, *more: Column) -> DataFrame:
    """A row per chunk: ``head`` up to its first end of a statement, NULL without one, the statements ``inner``, and
    the ``tail`` after the last."""
    text = F.col("text")
    closed = F.when(begin == 1, F.regexp_extract(text, _CLOSES[0], 0)).when(begin == 2, F.regexp_extract(text, _CLOSES[1], 0)).otherwise("")
    rows = chunks.withColumn("closed", closed)
    inside = (begin > 0) & (F.col("closed") == "")
    pieces = F.when(~inside, _find(F.substr(text, F.char_length("closed") + 1), _STATEMENT)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("pieces", pieces)
    last = F.try_element_at("pieces", F.lit(-1))
    rows = rows.withColumn("done", F.size("pieces") - F.when(last.rlike(_IS_DONE), 0).otherwise(1))
    ended = F.col("done") > 0
    return rows.select(
        "file", "part", "chunk",
        F.when(ended, F.concat("closed", F.get("pieces", F.lit(0)))).alias("head"),
        F.when(ended, F.coalesce(F.get("pieces", F.col("done")), F.lit(""))).otherwise(text).alias("tail"),
        F.when(ended, F.slice("pieces", F.lit(2), F.col("done") - 1)).otherwise(F.array().cast("array<string>")).alias("inner"), *more)


def _cut(chunks: DataFrame) -> DataFrame:
    """The pieces of each chunk. All are cut as if they began outside of strings, those that do not are then cut again."""
    first = stage(_pieces(chunks, F.lit(0), _how_it_ends(F.col("text")).alias("ends")), "turtle-cut")
    cut = first.drop("ends")
    own = first.select("file", "part", "chunk", "ends")
    if own.where(F.col("ends") != F.array(F.lit(0), F.lit(1), F.lit(2))).isEmpty():
        return cut
    keys = ["file", "part", "chunk"]
    begins = stage(_beginnings(own), "turtle-begins")
    whole = F.concat(F.coalesce("head", F.lit("")), F.array_join("inner", ""), F.col("tail"))
    again = _pieces(cut.join(begins, keys).select(*keys, whole.alias("text"), "begins"), F.col("begins"))
    return stage(cut.join(begins, keys, "left_anti").unionByName(again), "turtle-cut")


def _over_chunks(cut: DataFrame) -> DataFrame:
    """Statements that begin in one chunk and end in another, with the place where they end."""
    ended = F.when(F.col("head").isNotNull(), 1).otherwise(0).cast("bigint")
    ends = cut.select("file", "part", "chunk", "head", "tail")
    ends = running(ends, ["file"], ["part", "chunk"], F.col("part"), {"before": ("sum_before", ended)})
    before = F.coalesce("before", F.lit(0))
    fragment = lambda group, text: F.struct(group.alias("group"), F.col(text).alias("text"))
    both = F.array(fragment(before, "head"), fragment(before + ended, "tail"))
    pieces = ends.select("file", "part", "chunk", F.explode(both).alias("f")).where("f.text IS NOT NULL")
    whole = pieces.groupBy("file", "f.group").agg(
        F.array_sort(F.collect_list(F.struct("part", "chunk", "f.text"))).alias("of")
    ).select("file", F.array_join("of.text", "\n").alias("text"), F.element_at("of", -1).alias("last"))
    whole = whole.withColumn("pieces", _find(F.col("text"), _STATEMENT))
    return whole.select("file", F.posexplode("pieces").alias("at", "statement"), "last", F.size("pieces").alias("n")).select(
        "file", F.struct("last.part", "last.chunk", F.col("at").cast("bigint").alias("at")).alias("place"), "statement",
        ((F.col("at") < F.col("n") - 1) | F.col("statement").rlike(_IS_DONE)).alias("ends"))


def _changes(statements: DataFrame) -> DataFrame:
    """``file, known``: the declarations of each file in order, without those that change nothing."""
    found = statements.where(F.col("statement").rlike(_IS_DIRECTIVE)).select("file", "place", _declaration(F.col("statement")).alias("d"))
    found = found.where("d IS NOT NULL").select("file", "place", "d.name", "d.iri")
    before = F.lag("iri").over(Window.partitionBy("file", "name").orderBy("place"))
    # A relative IRI can mean another one after the base has changed.
    new = ~before.eqNullSafe(F.col("iri")) | ~F.col("iri").rlike(_SCHEME)
    found = found.withColumn("new", new).where("new")
    declared = F.transform(F.array_sort(F.collect_list(F.struct("place", "name", "iri"))),
                           lambda d: F.struct(d["name"].alias("name"), d["place"].alias("place"), d["iri"].alias("iri")))
    return found.groupBy("file").agg(declared.alias("declared")).select("file", _in_order(F.col("declared")).alias("known"))


def read_turtle(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Turtle files under a path as quads of the default graph (not yet a set).

    Modes are those of :func:`quadrille.sources.rdf_lines.parse_statements`, by whole statements.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"))
    return parse_turtle(lines, mode)


def parse_turtle(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Turtle lines ``value, file, part``: the lines of a part stand together and in order, and ``part``
    orders the parts of a file from 0 on."""
    if mode not in ("FAILFAST", "DROPMALFORMED", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    cut = _cut(lines.select("value", "file", "part").mapInArrow(_chunks, "file string, part bigint, chunk bigint, text string"))
    # Statements within a chunk come after those that end in it.
    inner = cut.select("file", "part", "chunk", F.posexplode("inner").alias("at", "statement")).select(
        "file", F.struct("part", "chunk", (F.col("at") + (1 << 32)).alias("at")).alias("place"), "statement",
        F.lit(True).alias("ends"))
    statements = inner.unionByName(_over_chunks(cut)).where(~F.col("statement").rlike(_BLANK))
    known = stage(_changes(statements), "turtle-known")
    scope = F.concat(F.lower(F.hex(F.xxhash64("file"))), F.lit("."))
    # What names mean after the last declaration of a file, which is before nearly all of its statements.
    names = F.map_from_entries(F.transform(F.array_distinct(F.transform("known", lambda d: d["name"])), lambda n: F.struct(
        n, F.try_element_at(F.filter("known", lambda d: d["name"] == n), F.lit(-1))["iri"])))
    known = known.select("file", "known", F.array_max(F.transform("known", lambda d: d["place"])).alias("last"),
                         F.map_filter(names, lambda _, iri: iri.isNotNull()).alias("names"))
    rows = statements.where(~F.col("statement").rlike(_PLAIN_DIRECTIVE)).join(known, "file", "left").select(
        scope.alias("scope"), "place", "statement", "ends", "last", F.coalesce("known", F.array().cast(_KNOWN)).alias("known"),
        F.coalesce("names", F.create_map().cast("map<string,string>")).alias("names"))
    is_rare = F.col("rows").isNull()
    rows = _plain_rows(rows).select(
        "scope", F.when(is_rare, F.struct("statement", "ends", "known", "place")).alias("rare"), F.when(~is_rare, F.col("names")).alias("names"),
        F.substring_index(F.get("rows", F.lit(0)), _SEP, 1).alias("subject"), F.explode_outer("rows").alias("row"))
    parsed = rows.select("scope", "names", "subject", F.split("row", _SEP).alias("row"), F.when(F.col("rare").isNotNull(), _parsed(
        F.col("rare.statement"), F.col("rare.ends"), F.col("rare.known"), F.col("rare.place"), F.col("scope"))).alias("r"))
    # An outer explode, and one condition on what comes out of it: others would be pushed below and parse once more.
    each = parsed.select("scope", "names", "subject", "row", "r.text", F.explode_outer("r.triples").alias("rare"))
    plain = _plain_triple(F.col("row"), F.col("subject"), F.col("names"), F.col("scope"))
    is_plain = F.col("row").isNotNull()
    each = each.select("text", F.when(is_plain, F.struct(*(plain[c].alias(c) for c in TRIPLE_COLS))).otherwise(F.col("rare")).alias("t"))
    columns = [F.lit(None).cast("string").alias("g"), *(F.col(f"t.{c}") for c in TRIPLE_COLS)]
    if mode == "PERMISSIVE":
        kept = each.where("t IS NOT NULL OR text IS NOT NULL")
        return kept.select(*columns, F.col("text").alias("_corrupt_record")).select(*QUAD_COLS, "_corrupt_record")
    good = F.col("t").isNotNull()
    if mode == "FAILFAST":
        message = F.concat(F.lit("malformed or unsupported Turtle: "), F.col("text"))
        good = F.when(good, True).when(F.col("text").isNull(), False).otherwise(F.raise_error(message).cast("boolean"))
    return each.where(good).select(*columns).select(*QUAD_COLS)
