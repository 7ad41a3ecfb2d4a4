"""Scalar functions on RDF terms. All are native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import XSD_STRING


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- names ------------------------------------------------------------------------------------

# NCName characters of "Namespaces in XML 1.0" (name characters without the colon).
NC_START = (
    "A-Z_a-z\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{2FF}\\x{370}-\\x{37D}\\x{37F}-\\x{1FFF}"
    "\\x{200C}-\\x{200D}\\x{2070}-\\x{218F}\\x{2C00}-\\x{2FEF}\\x{3001}-\\x{D7FF}"
    "\\x{F900}-\\x{FDCF}\\x{FDF0}-\\x{FFFD}"
)
NC_CHAR = NC_START + "\\-.0-9\\x{B7}\\x{300}-\\x{36F}\\x{203F}-\\x{2040}"
NCNAME = f"[{NC_START}][{NC_CHAR}]*"


def local_name(value: str | Column) -> Column:
    """Text after the last ``/`` or ``#``; the whole string when there is neither."""
    return F.regexp_replace(col(value), "(?s)^.*[/#]", "")


def namespace_split(uri: str | Column) -> Column:
    """Index (from 0) where the longest NCName at the end of an IRI starts.

    The index is the length when there is no such name. A percent escape is never cut in two, and at
    least one character stays after ``mailto:`` outside the name.
    """
    u = col(uri)
    tail = F.regexp_extract(u, f"([{NC_CHAR}]*)\\z", 1)
    start = F.length(u) - F.length(tail)
    # A tail that begins inside "%xx" must begin after it.
    cut = F.when(F.substring(u, start, F.lit(1)) == "%", F.substring(tail, F.lit(3), F.length(tail)))
    tail = F.coalesce(cut, tail)
    local = F.regexp_extract(tail, f"({NCNAME})\\z", 1)
    local = F.when(
        u.startswith("mailto:") & (F.length(u) - F.length(local) == 7),
        F.regexp_extract(F.substring(local, F.lit(2), F.length(local)), f"({NCNAME})\\z", 1),
    ).otherwise(local)
    return (F.length(u) - F.length(local)).cast("int")


# --- typed values -----------------------------------------------------------------------------


def as_type(value: str | Column, kind: str) -> Column:
    """A lexical form as the named type; NULL when it is not in the lexical space.

    Kinds: ``string short int bigint integer boolean iri local_name``. ``bigint`` is an integer of up to 38
    digits; ``integer`` one of any length, as its canonical text.
    """
    v = col(value)
    trimmed = F.trim(v)
    if kind == "string":
        return v
    if kind in ("short", "int", "bigint"):
        target = {"short": "smallint", "int": "int", "bigint": "decimal(38,0)"}[kind]
        return F.when(trimmed.rlike("^[+-]?[0-9]+$"), trimmed.try_cast(target))
    if kind == "integer":
        digits = F.regexp_replace(trimmed, "^[+-]?0*(?=[0-9])", "")
        sign = F.when(trimmed.startswith("-") & (digits != "0"), F.lit("-")).otherwise(F.lit(""))
        return F.when(trimmed.rlike("^[+-]?[0-9]+$"), F.concat(sign, digits))
    if kind == "boolean":
        return F.when(trimmed.isin("true", "1"), True).when(trimmed.isin("false", "0"), False)
    if kind == "iri":
        return F.when(F.instr(v, ":") > 0, v)
    if kind == "local_name":
        return local_name(v)
    raise ValueError(f"unknown kind {kind!r}")


def parse_boolean(body: str | Column, strict: bool = True) -> Column:
    """A text/boolean body. Strict: any letter case of true or false, else NULL (a failure).

    Lenient: true only for the word true in any letter case, false for all else and for no body.
    """
    low = F.lower(col(body))
    if strict:
        return F.when(low.isin("true", "false"), low == "true")
    return F.coalesce(low == "true", F.lit(False))


def format_date(ts: str | Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ssZ`` in the session time zone."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ssZ")


# --- N-Triples spelling -----------------------------------------------------------------------

#: An escaped character of Unicode: no surrogate, and none beyond the last code point.
UNICODE_ESCAPE = (
    "\\\\u(?![Dd][89A-Fa-f])[0-9A-Fa-f]{4}"
    "|\\\\U(?:0010|000(?!0[Dd][89A-Fa-f])[0-9A-Fa-f])[0-9A-Fa-f]{4}"
)

# Characters an IRI may not hold as they are, with their escapes.
_IRI_ESCAPES = [
    ("\\", "\\u005C"), (" ", "\\u0020"), ('"', "\\u0022"), ("<", "\\u003C"), (">", "\\u003E"),
    ("^", "\\u005E"), ("`", "\\u0060"), ("{", "\\u007B"), ("|", "\\u007C"), ("}", "\\u007D"),
    ("\t", "\\u0009"), ("\n", "\\u000A"), ("\r", "\\u000D"),
]
_LITERAL_ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")]


def _replace_all(value: Column, pairs: list[tuple[str, str]]) -> Column:
    for plain, escaped in pairs:
        value = F.replace(value, F.lit(plain), F.lit(escaped))
    return value


def escape_iri(value: Column) -> Column:
    return F.when(
        value.rlike('[\\x00-\\x20<>"{}|^`\\\\]'), _replace_all(value, _IRI_ESCAPES)
    ).otherwise(value)


def escape_literal(value: Column) -> Column:
    return F.when(value.rlike('[\\\\"\\n\\r]'), _replace_all(value, _LITERAL_ESCAPES)).otherwise(value)


def unescape(lexical: Column) -> Column:
    """Undo the escapes of N-Triples; NULL when an escape is not one of the grammar or no character."""
    # Most escapes are those of JSON. The two that are not are put right token by token, and only
    # in text that has them: \' and \U followed by eight hex digits.
    as_json = F.get_json_object(F.concat(F.lit('{"v":"'), lexical, F.lit('"}')), "$.v")
    tokens = F.regexp_extract_all(
        lexical, F.lit("\\\\U[0-9A-Fa-f]{8}|(?s)\\\\.|[^\\\\]+"), F.lit(0)
    )
    char = lambda t: F.decode(F.unhex(F.substring(t, 3, 8)), "UTF-32")
    quoted = lambda c: F.when(c.isin('"', "\\"), F.concat(F.lit("\\"), c)).otherwise(c)
    respelled = F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(t == "\\'", F.lit("'"))
            .when(t.rlike(f"^(?:{UNICODE_ESCAPE})$") & t.startswith("\\U"), quoted(char(t)))
            .otherwise(t),
        ),
        "",
    )
    long_json = F.get_json_object(F.concat(F.lit('{"v":"'), respelled, F.lit('"}')), "$.v")
    # Backslashes in pairs, other escapes, then one of a number that is no character.
    no_char = lexical.rlike(f"^(?:[^\\\\]|\\\\[^uU]|{UNICODE_ESCAPE})*+\\\\[uU]")
    return (
        F.when(~F.contains(lexical, F.lit("\\")), lexical)
        .when(no_char, F.lit(None).cast("string"))
        .when(F.contains(lexical, F.lit("\\U")) | F.contains(lexical, F.lit("\\'")), long_json)
        .otherwise(as_json)
    )


def nt_term(value: str, kind: str, datatype: str | None = None, lang: str | None = None) -> Column:
    """The named term columns in N-Triples spelling. ``xsd:string`` is left out."""
    v, k = F.col(value), F.col(kind)
    resource = F.when(k == "bnode", F.concat(F.lit("_:"), v)).otherwise(
        F.concat(F.lit("<"), escape_iri(v), F.lit(">"))
    )
    if datatype is None:
        return resource
    suffix = F.when(F.col(lang).isNotNull(), F.concat(F.lit("@"), F.col(lang))).when(
        F.col(datatype) != XSD_STRING, F.concat(F.lit("^^<"), escape_iri(F.col(datatype)), F.lit(">"))
    )
    quoted = F.concat(
        F.lit('"'), escape_literal(v), F.lit('"'), F.coalesce(suffix, F.lit(""))
    )
    return F.when(k == "literal", quoted).otherwise(resource)


def nt_iri(value: str) -> Column:
    return F.concat(F.lit("<"), escape_iri(F.col(value)), F.lit(">"))


# --- content types ----------------------------------------------------------------------------

# Media types of the RDF formats in use.
FORMAT_OF_MEDIA_TYPE = {
    "application/n-triples": "NTRIPLES",
    "application/n-quads": "NQUADS",
    "text/x-nquads": "NQUADS",
    "text/turtle": "TURTLE",
    "application/ld+json": "JSONLD",
    "application/octet-stream": "NTRIPLES",
}
MEDIA_TYPE_OF_FORMAT = {
    "NTRIPLES": "application/n-triples",
    "NQUADS": "application/n-quads",
    "TURTLE": "text/turtle",
    "JSONLD": "application/ld+json",
}
RESULTS_JSON = "application/sparql-results+json"
TEXT_BOOLEAN = "text/boolean"


def media_type(content_type: str | Column) -> Column:
    """The media type without parameters such as the charset."""
    return F.lower(F.trim(F.substring_index(col(content_type), ";", 1)))


def _look_up(key: Column, table: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def rdf_format_of(content_type: str | Column) -> Column:
    """RDF format of a content type, NULL when it is none. Octet streams count as N-Triples."""
    return _look_up(media_type(content_type), FORMAT_OF_MEDIA_TYPE)


def content_type_of(rdf_format: str | Column) -> Column:
    """Content type an RDF format is sent with."""
    return _look_up(col(rdf_format), MEDIA_TYPE_OF_FORMAT)


def is_results_json(content_type: str | Column) -> Column:
    return F.coalesce(media_type(content_type) == RESULTS_JSON, F.lit(False))
