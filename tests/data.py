"""A lamp shop: 19 quads of its stock and 5 of its archive."""

from quadrille.schema import QUAD_SCHEMA, RDF_TYPE, XSD_STRING

MODEL, ALT = "urn:shop:stock", "urn:shop:archive"
LABEL, COMMENT, KIND = "urn:shop:name", "urn:shop:note", "urn:shop:kind:lamp"
N_MODEL, N_ALT = 19, 5


def res(i):
    return f"urn:shop:item:{i}"


def uri(g, s, p, o):
    return (g, s, "uri", p, o, "uri", None, None)


def text(g, s, p, o, datatype=XSD_STRING, lang=None):
    return (g, s, "uri", p, o, "literal", datatype, lang)


def rows():
    stock = [(i, p, v) for i in range(9) for p, v in ((LABEL, f"Lamp {i}"), (COMMENT, f"Needs {i} bulbs"))]
    archive = [(i, LABEL, f"Old lamp {i}") for i in range(4)]
    return (
        [uri(g, res(0), RDF_TYPE, KIND) for g in (MODEL, ALT)]
        + [text(MODEL, res(i), p, v) for i, p, v in stock]
        + [text(ALT, res(i), p, v) for i, p, v in archive]
    )


def frame(spark, data):
    return spark.createDataFrame(data, QUAD_SCHEMA)


def as_set(df):
    return {tuple(r) for r in df.collect()}
