"""Relational tables as quads: one subject per row, one statement per column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, RDF_LANGSTRING, RDF_TYPE, XSD

@dataclass(frozen=True)
class Entity:
    """How a table maps to quads.

    ``columns`` gives per column the XSD type of its literals, ``@<column>`` for text in the language
    that column names, or ``-> <table>`` for a foreign key.
    """

    table: str
    key: str
    columns: dict[str, str]
    graph: str | None


def subject_of(table: str, key: Column) -> Column:
    return F.concat(F.lit(f"urn:{table}:"), key.cast("string"))


def lexical(value: Column, xsd_type: str) -> Column:
    if xsd_type == "decimal":
        return value.cast("decimal(18,2)").cast("string")
    if xsd_type == "dateTime":
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    return value.cast("string")


def to_quads(table: DataFrame, entity: Entity) -> DataFrame:
    """All statements of the rows of a table, in one scan."""
    no = F.lit(None).cast("string")

    def row(p: str, o: Column, o_type: str, datatype: Column = no, lang: Column = no) -> Column:
        return F.struct(
            F.lit(p).alias("p"), o.alias("o"), F.lit(o_type).alias("o_type"),
            datatype.alias("o_datatype"), lang.alias("o_lang"),
        )

    rows = [row(RDF_TYPE, F.lit(f"urn:type:{entity.table}"), "uri")]
    for name, kind in entity.columns.items():
        value = F.col(name)
        if kind.startswith("-> "):
            rows.append(row(f"urn:p:{name}", subject_of(kind[3:], value), "uri"))
        elif kind.startswith("@"):
            rows.append(
                row(f"urn:p:{name}", value, "literal", F.lit(RDF_LANGSTRING), F.col(kind[1:]))
            )
        else:
            rows.append(row(f"urn:p:{name}", lexical(value, kind), "literal", F.lit(XSD + kind)))
    return (
        table.select(
            F.lit(entity.graph).cast("string").alias("g"),
            subject_of(entity.table, F.col(entity.key)).alias("s"),
            F.lit("uri").alias("s_type"),
            F.explode(F.array(*rows)).alias("_r"),
        )
        .select("g", "s", "s_type", "_r.*")
        .where(F.col("o").isNotNull())
        .select(*QUAD_COLS)
    )
