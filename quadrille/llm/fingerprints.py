"""Document fingerprints by MinHash.

A text's shingles of words are hashed to 64 bits and go through universal hash permutations
``a * x + b modulo 2 ** 64`` with odd ``a``; the least value of each is the signature. The fingerprint keeps
the lowest of the upper 32 bits of each value, eight bits of it, as hexadecimal text. Signatures are made for
whole runs of texts at once in numpy; repeated shingles do not change a minimum, so no set is built.

``near_duplicates`` joins bands of the signatures in Spark and verifies the Jaccard similarity of what meets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quadrille.llm import ngram_join, sharding, shingles
from quadrille.llm.components import connected
from quadrille.session import stage

WIDTH, PERMUTATIONS = 5, 128
#: Rows of a band of ``near_duplicates``: pairs at a Jaccard similarity of 0.8 meet with 0.9999.
BAND = 4
#: Bytes of text of one task of the pass in order of ``doc_id``, about.
PART_BYTES = 16 << 20


class MinHash:
    """Signatures of runs of texts."""

    def __init__(self, width: int = WIDTH, permutations: int = PERMUTATIONS) -> None:
        self.width = width
        self.hasher = shingles.Hasher()
        seeds = shingles.mix(np.arange(2 * permutations, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
        self.a, self.b = seeds[:permutations] | np.uint64(1), seeds[permutations:]

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """One row of 32-bit values per text; all ones for a text without words."""
        out = np.full((len(texts), len(self.a)), 0xFFFFFFFF, np.uint32)
        for begin, end in shingles.runs(texts):
            found = list(self.hasher.shingles(texts[begin:end], self.width))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            x = np.concatenate(found)
            first = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            v = np.empty_like(x)
            for i in range(len(self.a)):
                np.multiply(x, self.a[i], out=v)
                np.add(v, self.b[i], out=v)
                out[begin + full, i] = np.minimum.reduceat(v, first) >> np.uint64(32)
        return out


def is_blank(signatures: np.ndarray) -> np.ndarray:
    return (signatures == 0xFFFFFFFF).all(axis=1)


def fingerprint(signatures: np.ndarray) -> list[str]:
    low = (signatures & 0xFF).astype(np.uint8)
    return [row.tobytes().hex() for row in low]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from what fingerprints keep: equal bytes less those equal by chance."""
    same = ((a & 0xFF) == (b & 0xFF)).mean(axis=1)
    out = np.maximum(0.0, (same - 1 / 256) / (1 - 1 / 256))
    return np.where(is_blank(a) != is_blank(b), 0.0, out)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _compare(width: int, permutations: int):
    """Rows come in order of part and place; the last of each part only closes it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        minhash = MinHash(width, permutations)
        pending: tuple | None = None
        for batch in batches:
            rows = list(zip(batch["part"], batch["doc_id"].astype("Int64"), batch["text"]))
            if pending is not None:
                rows.insert(0, pending)
            pending = rows[-1]
            texts = [r[2] for r in rows]
            plain = [_encode(t) for t in texts]
            pairs = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0]]
            own = minhash.signatures(plain)
            if not pairs:
                continue
            changed = [_encode(edited(texts[i], texts[i + 1])) for i in pairs]
            other = minhash.signatures(changed)
            at = np.array(pairs)
            yield pd.DataFrame({
                "doc_id": pd.array([rows[i][1] for i in pairs], "Int64"),
                "n_chars": [len(texts[i]) for i in pairs],
                "edited_sha256": [hashlib.sha256(t).hexdigest() for t in changed],
                "fingerprint": fingerprint(own[at]),
                "edited_fingerprint": fingerprint(other),
                "near_edited": likeness(own[at], other),
                "near_next": likeness(own[at], own[at + 1]),
            })

    return run


def fingerprint_documents(docs: DataFrame, width: int = WIDTH, permutations: int = PERMUTATIONS) -> DataFrame:
    """Fingerprints of each document, of its edited text, and how near they and the next document are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The
    next document is that with the next larger ``doc_id``, after the last comes the first; a single
    document is its own next. A NULL text counts as empty. A text without words has the fingerprint of the
    empty text, is 1 near another such text and 0 near any other. Rows without ``doc_id`` come first; rows of one
    ``doc_id`` are ordered by a hash of the text, and repeated rows are alike. Other columns are ignored.
    An empty table gives an empty result.

    The texts move once, to ranges of ``doc_id`` of about equal bytes; the first row of each range is also sent
    to the range before it.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k1"),
        F.when(F.col("doc_id").isNull(), -1).otherwise(0).cast("long").alias("k2"), F.xxhash64("text").alias("k3"))
    keys = stage(rows.select("k1", "k2", "k3", (F.octet_length("text") + 16).cast("long").alias("size")), "text-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    cuts = sharding.splitters(keys, parts, 0.2)

    @pandas_udf("int")
    def part_of(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        return pd.Series(sharding.cell_of(cuts, k1.to_numpy(), k2.to_numpy(), k3.to_numpy()))

    part = part_of("k1", "k2", "k3")
    key = F.struct("k1", "k2", "k3")
    # One row per part, which is less than a row for PART_BYTES of text.
    firsts = keys.withColumn("part", part).groupBy("part").agg(F.min(key).alias("first"))
    firsts = firsts.select(
        "first.*", F.coalesce(F.lag("part").over(Window.orderBy("part")), F.lit(-1)).alias("part"))
    last = F.lit(keys.withColumn("part", part).agg(F.max("part")).first()[0])
    firsts = firsts.withColumn("part", F.when(F.col("part") < 0, last).otherwise(F.col("part")))
    closing = (
        rows.join(F.broadcast(firsts), ["k1", "k2", "k3"]).dropDuplicates(["part"])
        .select("part", F.lit(1).alias("closing"), "k1", "k2", "k3", "doc_id", "text")
    )
    ordered = (
        rows.withColumn("part", part).select("part", F.lit(0).alias("closing"), "k1", "k2", "k3", "doc_id", "text")
        .unionByName(closing).repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
        .sortWithinPartitions("part", "closing", "k1", "k2", "k3").select("part", "doc_id", "text")
    )
    return ordered.mapInPandas(
        _compare(width, permutations),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _bands(width: int, permutations: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        minhash, seen = MinHash(width, permutations), set()
        for batch in batches:
            texts = [t or b"" for t in batch["text"]]
            keys = [shingles.set_key(s) for s in shingles.sets(texts, width, minhash.hasher)]
            new = [i for i, k in enumerate(keys) if k not in seen]
            seen.update(keys)
            signatures = minhash.signatures([texts[i] for i in new])
            own = np.array([keys[i] for i in new], np.int64)[~is_blank(signatures)]
            signatures = signatures[~is_blank(signatures)].astype(np.uint64)
            for i in range(0, permutations, BAND):
                band = np.full(len(own), i, np.uint64)
                for j in range(i, i + BAND):
                    band = shingles.mix(band ^ signatures[:, j])
                yield pd.DataFrame({"band": band.view(np.int64), "key": own})

    return run


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = WIDTH,
                    permutations: int = PERMUTATIONS) -> DataFrame:
    """Groups of documents whose sets of shingles have a Jaccard similarity of ``percent`` or more.

    One row per document: ``doc_id, n_shingles, component_id, n_links`` as for the n-gram join. Sets that meet
    in a band make up families, directly or over others; all pairs of a family are verified exactly. A
    pair at the threshold is missed with a chance of about ``(1 - 0.8 ** BAND) ** (permutations / BAND)``.
    A NULL or empty text and one without words has no shingles and is linked with nothing; repeated rows and equal texts are
    in one group; other columns are ignored; an empty table gives an empty result.
    """
    described = ngram_join.describe_sets(docs, width)
    rows = described.where("slice is null").select("doc_id", "tid", "n", "key")
    classes = ngram_join.set_classes(rows)
    bands = stage(docs.select(F.col("text").cast("binary").alias("text"))
                  .mapInPandas(_bands(width, permutations), "band long, key long"), "bands")
    met = bands.groupBy("band").agg(F.min("key").alias("v"), F.max("key").alias("last")).where("v != last")
    families = connected(bands.join(met, "band").select(F.col("key").alias("u"), "v"))
    return ngram_join.link_families(docs, rows, classes, families, width, percent).drop("tid", "root")
