"""N-Triples and N-Quads: one statement per line, parsed by native expressions.

Lines are independent, so a file of any size is split over tasks and a body held in one cell is
exploded in lines. Each line costs one regular-expression match: it is rewritten as its fields with a
separator between them, and cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import UNICODE_ESCAPE, unescape
from ..schema import QUAD_COLS, RDF_LANGSTRING, XSD_STRING, demand

_UCHAR = UNICODE_ESCAPE
_IRI_CHARS = "[^<>\"{}|^`\\\\\\x00-\\x20]*+"
_IRI = f"<{_IRI_CHARS}(?:(?:{_UCHAR}){_IRI_CHARS})*+>"
_BNODE = "_:[^\\s<>\"]*[^\\s<>\".]"
_TEXT = "[^\"\\\\]*+"
# The possessive loops neither backtrack nor recurse, however long the text is.
_LITERAL = f"\"({_TEXT}(?:(?:\\\\[tbnrf\"'\\\\]|{_UCHAR}){_TEXT})*+)\""
_SUFFIX = f"(?:\\^\\^({_IRI})|@([a-zA-Z]+(?:-[a-zA-Z0-9]+)*))?"
_HEAD = f"(?s)^\\s*({_IRI}|{_BNODE})\\s*({_IRI})\\s*(?:({_IRI}|{_BNODE})|{_LITERAL}{_SUFFIX})"
_GRAPH = f"\\s*({_IRI}|{_BNODE})?"
_END = "\\s*\\.\\s*(?:#.*)?\\z"
_STATEMENT = {True: _HEAD + _GRAPH + _END, False: _HEAD + "()" + _END}
_SEP = "\x01"
# The literal comes last, so that a separator inside it does not matter.
_FIELDS = _SEP.join(["$1", "$2", "$3", "$5", "$6", "$7", "$4"])


def is_statement(line: Column, quads: bool = True) -> Column:
    """The line is a statement of N-Quads, or of N-Triples."""
    return line.rlike(_STATEMENT[quads])


def _fields(line: Column, quads: bool) -> Column:
    """Subject, predicate, object IRI, datatype, language, graph, literal; another line is one field.

    Fields that are not there are empty. A field with an escape that means no character is NULL.
    """
    cut = F.split(F.regexp_replace(line, _STATEMENT[quads], _FIELDS), _SEP, 7)
    # A line that is no statement comes through whole: one field, unless it has a separator itself.
    cut = F.when(~F.contains(line, F.lit(_SEP)) | is_statement(line, quads), cut)
    return F.when(F.contains(line, F.lit("\\")), F.transform(cut, unescape)).otherwise(cut)


def _statement(f: Column, scope: Column) -> dict[str, Column]:
    """Quad columns from the fields of a line, and ``ok``: the line was a statement."""
    get = lambda i: F.get(f, F.lit(i))
    at = lambda i: F.nullif(get(i), F.lit(""))
    is_bnode = lambda c: c.startswith("_:")

    def resource(c: Column) -> Column:
        return F.when(is_bnode(c), F.concat(scope, F.substring(c, F.lit(3), F.length(c)))).otherwise(
            F.substring(c, F.lit(2), F.length(c) - 2)
        )

    def kind(c: Column) -> Column:
        return F.when(is_bnode(c), "bnode").when(c.isNotNull(), "uri")

    literal = get(2) == ""
    plain = F.when(get(4) != "", RDF_LANGSTRING).otherwise(XSD_STRING)
    return {
        "g": resource(at(5)),
        "s": resource(get(0)),
        "s_type": kind(get(0)),
        "p": resource(get(1)),
        "o": F.when(literal, get(6)).otherwise(resource(get(2))),
        "o_type": F.when(literal, "literal").otherwise(kind(get(2))),
        "o_datatype": F.when(literal, F.coalesce(resource(at(3)), plain)),
        "o_lang": F.when(literal, at(4)),
        "ok": (F.size(f) == 7) & ~F.exists(f, lambda x: x.isNull()),
    }


def _has_content(line: Column) -> Column:
    return ~line.rlike("^\\s*(?:#|\\z)")


def body_is_valid(body: Column, quads: bool = True) -> Column:
    """Every line of a body held in one cell is a statement, empty or a comment."""
    return F.forall(F.split(body, "\n"), lambda line: ~_has_content(line) | is_statement(line, quads))


def cell_quads(body: Column, scope: Column, quads: bool = True) -> Column:
    """The statements of a body held in one cell, as an array; NULL if one of its lines is neither a statement nor
    empty nor a comment.

    All of it is settled inside the row: to keep or drop a body as a whole needs no shuffle.
    """
    lines = F.filter(F.split(body, "\n"), _has_content)
    of = lambda f: F.struct(*[c.alias(n) for n, c in _statement(f, scope).items()])
    parsed = F.transform(lines, lambda line: F.get(F.transform(F.array(_fields(line, quads)), of), F.lit(0)))
    quad = lambda r: F.struct(*[r[c].alias(c) for c in QUAD_COLS])
    whole = lambda rs: F.when(F.forall(rs, lambda r: r["ok"]), F.transform(rs, quad))
    return F.get(F.transform(F.array(parsed), whole), F.lit(0))


def parse_statements(
    lines: DataFrame,
    line: str = "value",
    scope: Column | None = None,
    mode: str = "PERMISSIVE",
    quads: bool = True,
) -> DataFrame:
    """Parse a column of lines into quad columns, keeping all other columns.

    ``scope`` is put in front of blank node labels, which are local to their document. ``mode`` says
    what happens to lines that are not statements: ``FAILFAST`` raises, ``DROPMALFORMED`` drops them,
    ``PERMISSIVE`` keeps them with the text in ``_corrupt_record``. Empty lines and comments are not
    statements and never errors. With ``quads=False`` a graph name makes a line malformed.
    """
    if mode not in ("FAILFAST", "DROPMALFORMED", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    raw = F.col(line)
    rest = [c for c in lines.columns if c != line]
    # An explode, so that conditions on the fields are not pushed below and match each line once more.
    cut = lines.where(_has_content(raw)).select(*rest, raw.alias("_line"), F.explode(F.array(_fields(raw, quads))).alias("_f"))
    columns = _statement(F.col("_f"), F.lit("") if scope is None else scope)
    parsed = cut.select(*rest, "_line", *[c.alias(n) for n, c in columns.items()])
    ok = F.coalesce(F.col("ok"), F.lit(False))
    if mode == "DROPMALFORMED":
        return parsed.where(ok).select(*rest, *QUAD_COLS)
    if mode == "FAILFAST":
        message = F.concat(F.lit("malformed statement: "), F.col("_line"))
        return demand(parsed, ok, message).select(*rest, *QUAD_COLS)
    return parsed.select(
        *rest,
        *[F.when(ok, F.col(c)).alias(c) for c in QUAD_COLS],
        F.when(~ok, F.col("_line")).alias("_corrupt_record"),
    )


def _read(spark: SparkSession, path: str | list[str], mode: str, quads: bool) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("_file"))
    scope = F.concat(F.lower(F.hex(F.xxhash64("_file"))), F.lit("."))
    return parse_statements(lines, scope=scope, mode=mode, quads=quads).drop("_file")


def read_ntriples(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """N-Triples files under a path as quads of the default graph (not yet a set)."""
    return _read(spark, path, mode, quads=False)


def read_nquads(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """N-Quads files under a path as quads (not yet a set)."""
    return _read(spark, path, mode, quads=True)


def frame_lines(df: DataFrame, body: str, max_length: int | None = None) -> DataFrame:
    """Cut a body in lines: adds ``frame_no``, ``frame`` and ``frame_error``.

    The end of the body closes the last frame, and no frame follows a final line feed. A frame
    longer than ``max_length`` characters has its text and an error.
    """
    pieces = F.split(F.col(body), "\n", -1)
    frames = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    rest = [c for c in df.columns if c != body]
    out = df.select(*rest, F.posexplode(frames).alias("frame_no", "frame"))
    if max_length is None:
        return out.withColumn("frame_error", F.lit(None).cast("string"))
    long = F.length("frame") > max_length
    return out.select(
        *rest,
        "frame_no",
        "frame",
        F.when(long, F.lit(f"frame longer than {max_length} characters")).alias("frame_error"),
    )
