"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words and word beginnings that labelled toxic documents hold far more often than
others. Features are densities of lexicon hits, how near second-person words stand to them, capitals,
punctuation and obfuscation (letters mixed with digits and signs, read back to plain letters).

Only labelled rows whose ``crc32(doc_id) mod 3`` is not 1 are learned from, at most ``sample`` of them,
taken by a hash of ``doc_id``. Three fifths of them make the lexicon, one fifth grows the trees, and one calibrates; where
one of the last two does not hold both classes, both grow the trees and calibrate.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quadrille.session import bound_batches, stage

#: Labelled rows learned from, and entries of the lexicon, at most.
SAMPLE, LEXICON = 20_000, 4_096
#: The least log-likelihood ratio statistic and log-odds of a lexicon entry.
EVIDENCE, LEAST_ODDS = 20.0, 2.0
PREFIXES = (4, 5, 6)
#: Words that a task remembers, and entries that it counts at a time, at most (but for those of one text).
CODES, COUNTED = 1 << 16, 1 << 17
#: Words this near count as said to someone.
NEAR = 8
EDGE = ".,;:!?\"'()[]{}<>*-_/\\|«»“”‘’…"

#: Second-person words of the languages in the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself you're u ur du dich dir dein deine deiner deinem deinen ihr euch euer tu te toi "
    "ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
#: Characters that stand for letters.
STAND_INS = str.maketrans("0134578@$!|", "oieastbasil")
OBFUSCATED = re.compile(r"[^\W\d_]+[\d@$!|*.#_-]+[^\W\d_]|[\d@$!|*#]+[^\W\d_]{2}")

FEATURES = ("hit_density", "hit_weight", "strongest", "hits", "kinds", "near_person", "person_density",
            "capitals", "shouted", "exclaims", "asks", "punctuation", "obfuscated", "hidden_hits")


def bare(word: str) -> str:
    return word.strip(EDGE).lower()


def entries_of(word: str) -> list[str]:
    """A word and its beginnings, which are marked by a closing star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)] if word else []


def _count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, clean = Counter(), Counter()

    def counted() -> pd.DataFrame:
        keys = list(toxic.keys() | clean.keys())
        out = pd.DataFrame({"entry": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})
        toxic.clear()
        clean.clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["toxic"]):
            found = {e for w in set((text or "").split()) for e in entries_of(bare(w))}
            (toxic if label else clean).update(found)
            if len(toxic) + len(clean) >= COUNTED:
                yield counted()
    yield counted()


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Entries with their log-odds, from rows ``text, toxic``; the strongest ``LEXICON`` of them."""
    totals = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return {}
    share = F.lit(pos / (pos + neg))
    n = F.col("toxic") + F.col("clean")
    evidence = 2 * (F.col("toxic") * F.log(F.col("toxic") / (n * share))
                    + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0))
    odds = F.log((F.col("toxic") + 0.5) / (pos + 1)) - F.log((F.col("clean") + 0.5) / (neg + 1))
    best = (
        labelled.select("text", "toxic").mapInPandas(_count_entries, "entry string, toxic long, clean long")
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic > 0").select("entry", evidence.alias("evidence"), odds.alias("odds"))
        .where((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("evidence"), "entry").limit(LEXICON)
    )
    return {r["entry"]: r["odds"] for r in best.collect()}


class WordCodes(dict):
    """What a word contributes, as one integer: weight of its entry in tenths (8 bits), entry (14 bits),
    letters (8), capitals (8), and flags for second person, shouting, obfuscation and a hidden hit."""

    PERSON, SHOUT, OBFUSCATED, HIDDEN = 38, 39, 40, 41

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.number = {e: i + 1 for i, e in enumerate(lexicon)}
        self.lexicon = lexicon

    def hit(self, word: str) -> str | None:
        found = [e for e in entries_of(word) if e in self.lexicon]
        return max(found, key=self.lexicon.__getitem__) if found else None

    def __missing__(self, word: str) -> int:
        plain = bare(word)
        entry = self.hit(plain)
        hidden = None
        odd = bool(OBFUSCATED.search(word))
        if odd and entry is None:
            hidden = self.hit("".join(c for c in plain.translate(STAND_INS) if c.isalpha()))
        entry = entry or hidden
        letters = sum(map(str.isalpha, word))
        capitals = sum(map(str.isupper, word))
        code = 0
        if entry:
            code = min(255, round(10 * self.lexicon[entry])) | self.number[entry] << 8
        code |= min(letters, 255) << 22 | min(capitals, 255) << 30
        code |= (plain in SECOND_PERSON) << self.PERSON | (letters > 2 and capitals == letters) << self.SHOUT
        code |= odd << self.OBFUSCATED | (hidden is not None) << self.HIDDEN
        if len(self) < CODES:
            self[word] = code
        return code


def features_of(text: str, codes: WordCodes) -> list[float]:
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    c = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    n = len(c)
    weight, entry = (c & 255) / 10.0, (c >> 8) & 0x3FFF
    at = np.flatnonzero(entry)
    person = np.flatnonzero((c >> codes.PERSON) & 1)
    near = 0.0
    if len(at) and len(person):
        k = np.searchsorted(person, at)
        gap = np.minimum(np.abs(at - person[np.minimum(k, len(person) - 1)]), np.abs(at - person[np.maximum(k - 1, 0)]))
        near = float((gap <= NEAR).mean())
    letters, capitals = int(((c >> 22) & 255).sum()), int(((c >> 30) & 255).sum())
    exclaims, asks = text.count("!"), text.count("?")
    other = sum(map(text.count, ".,;:-\"'()*"))
    return [len(at) / n, float(weight.sum()) / n, float(weight.max()), math.log1p(len(at)),
            float(len(np.unique(entry[at]))), near, len(person) / n, capitals / max(1, letters),
            float(((c >> codes.SHOUT) & 1).sum()) / n, exclaims / n, asks / n, other / n,
            float(((c >> codes.OBFUSCATED) & 1).sum()) / n, float(((c >> codes.HIDDEN) & 1).sum()) / n]


def with_features(docs: DataFrame, lexicon: dict[str, float], carry: str) -> DataFrame:
    """``features`` of each row, beside the columns that ``carry`` declares (``text`` is not kept)."""
    names = [c.split()[0] for c in carry.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes(lexicon)
        for batch in batches:
            out = batch[names].copy()
            out["features"] = [features_of(t or "", codes) for t in batch["text"]]
            yield out

    return docs.select(*names, "text").mapInPandas(run, f"{carry}, features array<double>")


def _fold(parts: int):
    return F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(parts))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Texts with labels that may be learned from: at most ``sample`` rows, in order of a hash of ``doc_id``."""
    may = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(may & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # At most `sample` rows of 12 bytes.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


class Model:
    """Lexicon, trees and calibration; a constant score where the labels do not hold both classes."""

    def __init__(self, lexicon: dict[str, float], trees=None, calibration=None, constant: float = 0.0) -> None:
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score`` of each row of ``doc_id, text``."""
        if self.trees is None:
            return docs.select("doc_id", F.lit(self.constant).alias("score"))
        rows = with_features(docs, self.lexicon, "doc_id long")
        return self.calibrated(rows).select("doc_id", "score")

    def raw(self, rows: DataFrame) -> DataFrame:
        rows = self.trees.transform(rows.withColumn("vector", array_to_vector("features")))
        return rows.withColumn("raw_score", vector_to_array("probability")[1])

    def calibrated(self, rows: DataFrame) -> DataFrame:
        out = self.calibration.transform(self.raw(rows))
        return out.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    bound_batches(docs.sparkSession)
    labelled = stage(labelled_sample(docs, labels, sample), "labelled")
    lexicon = learn_lexicon(labelled.where(_fold(5) < 3))
    rows = stage(with_features(labelled.where(_fold(5) >= 3), lexicon, "doc_id long, toxic int"), "features")
    by_fold = {(r["fold"], r["toxic"]): r["n"]
               for r in rows.groupBy(_fold(5).alias("fold"), "toxic").agg(F.count("*").alias("n")).collect()}
    counts = {t: sum(n for (_, toxic), n in by_fold.items() if toxic == t) for t in (0, 1)}
    if not counts[0] or not counts[1]:
        both = sum(counts.values())
        return Model(lexicon, constant=counts[1] / both if both else 0.0)
    apart = all(by_fold.get((fold, toxic)) for fold in (3, 4) for toxic in (0, 1))
    to_grow, to_calibrate = (rows.where(_fold(5) == 3), rows.where(_fold(5) == 4)) if apart else (rows, rows)
    label = F.col("toxic").cast("double")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxDepth=3, maxIter=15, stepSize=0.2, seed=7,
                          minInstancesPerNode=3)
    model = Model(lexicon, trees.fit(to_grow.withColumn("vector", array_to_vector("features")).withColumn("label", label)))
    scored = model.raw(to_calibrate).select("doc_id", "raw_score", label.alias("label"))
    model.calibration = IsotonicRegression(featuresCol="raw_score", labelCol="label",
                                           predictionCol="calibrated").fit(scored)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id, toxic``. ``held_out`` marks the rows that are
    never learned from, ``predicted`` is 1 from ``threshold`` on. A NULL or empty text is scored as one
    without words. Rows without ``doc_id`` are scored, not held out, and never learned from. Repeated
    documents are scored alike; of repeated labels the highest counts. Without labels of both classes
    every score is the share of toxic labels, 0 without any. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return train(rows, labels, sample).score(rows).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept, whatever their names.

    NULL and empty texts are scored as texts without words. Repeated rows and equal texts score alike, so all of them
    stay or go. An empty table stays empty. Without labels of both classes all rows have one score.
    """
    model = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                  labels, sample)
    if model.trees is None:
        return docs if model.constant < threshold else docs.where(F.lit(False))
    lexicon = model.lexicon

    @pandas_udf("array<double>")
    def features(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = WordCodes(lexicon)
        for texts in parts:
            yield pd.Series([features_of(t or "", codes) for t in texts])

    rows = docs.select(F.struct(*docs.columns).alias("row"), features(F.col("text").cast("string")).alias("features"))
    return model.calibrated(rows).where(F.col("score") < threshold).select("row.*")
