"""Language identification by multilingual mixture inference.

Every language has a model of letter trigrams, centred on each letter of a word, with the ends of words
as a letter. A word then has a likelihood under each language, and a document is a mixture: expectation
maximisation estimates the share of each language from the likelihoods of its words. The set of languages
is selected by penalised likelihood: languages are added in order of their share as long as the
log-likelihood grows by more than the penalty. A document whose words can not gain the penalty even if each
took its own best language has one language; that is exact and needs no iteration.

Trigrams are counted over all rows that may be learned from, those with ``crc32(doc_id) mod 4`` other than 2
and a language. The table sent to the tasks has ``2 ** CELL_BITS`` rows and a column per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

CELL_BITS = 16
#: Count given to each cell of each language beforehand.
SMOOTHING = 0.05
ROUNDS = 12
#: Log-likelihood that one more language must gain, per unit of ``log(1 + words)``.
PENALTY = 4.0
UNDETERMINED = "und"
RUN_LETTERS = 1 << 20


def _alphabet() -> np.ndarray:
    """The lower-case letter of each code point, 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _letters(texts: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with 0 between words, and where each text ends."""
    data = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return alphabet[data], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)


def _trigrams(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the letters are, and the cell of the trigram around each."""
    at = np.flatnonzero(letters)
    padded = np.concatenate(([0], letters, [0])).astype(np.uint64)
    h = (padded[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(29)) ^ (padded[at + 2] * np.uint64(0x165667B19E3779F9))) * np.uint64(0xBF58476D1CE4E5B9)
    return at, (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > RUN_LETTERS:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alphabet = _alphabet()
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, part in batch.groupby("lang"):
            total = totals.setdefault(lang, np.zeros(1 << CELL_BITS, np.int64))
            texts = part["text"].tolist()
            for a, b in _runs(texts):
                total += np.bincount(_trigrams(_letters(texts[a:b], alphabet)[0])[1], minlength=len(total))
    for lang, total in totals.items():
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "cell": cells, "n": total[cells]})


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the log-probability of each trigram cell under each."""
    may = F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 != 2
    counts = (
        docs.where(may & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
        .mapInPandas(_count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(counts["lang"].unique())
    table = np.full((1 << CELL_BITS, len(langs)), SMOOTHING)
    for k, lang in enumerate(langs):
        part = counts[counts["lang"] == lang]
        table[part["cell"].to_numpy(), k] += part["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32) if langs else table.astype(np.float32)


def mixture(words: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each document, and their log-likelihood less the best of each word.

    ``words`` has the log-likelihood of each word under each language, ``counts`` the words of each
    document, of which there is one at least, and ``start`` shares to begin with; what begins at 0 stays 0.
    """
    relative = np.exp(words - words.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    share = start
    for _ in range(ROUNDS):
        part = relative * np.repeat(share, counts, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, first, axis=0) / counts[:, None]
    fit = np.log((relative * np.repeat(share, counts, axis=0)).sum(axis=1))
    return share, np.add.reduceat(fit, first)


def select_languages(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of the selected languages in each document, 0 for the others."""
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    single = np.add.reduceat(words.astype(np.float64), first, axis=0)
    best = single.argmax(axis=1)
    chosen = np.zeros(single.shape)
    rows = np.arange(len(counts))
    chosen[rows, best] = 1.0
    top = np.add.reduceat(words.max(axis=1).astype(np.float64), first)
    fit = single[rows, best] - top
    penalty = PENALTY * np.log1p(counts)
    open_ = np.flatnonzero(-fit > penalty)
    if not len(open_):
        return chosen
    of = np.repeat(rows, counts)
    size = words.shape[1]
    inside = np.isin(of, open_)
    own, n = words[inside], counts[open_]
    share, _ = mixture(own, n, np.full((len(open_), size), 1.0 / size))
    order = np.argsort(-share, axis=1, kind="stable")
    # The best single language leads, then the others by their share.
    for i, d in enumerate(open_.tolist()):
        rest = [k for k in order[i].tolist() if k != best[d]]
        order[i] = [best[d], *rest]
    for k in range(2, size + 1):
        start = np.zeros((len(open_), size))
        np.put_along_axis(start, order[:, :k], 1.0 / k, axis=1)
        share, now = mixture(own, n, start)
        better = now - fit[open_] > penalty[open_]
        if not better.any():
            break
        chosen[open_[better]] = share[better]
        fit[open_[better]] = now[better]
        inside = np.repeat(better, n)
        own, n, order, open_ = own[inside], n[better], order[better], open_[better]
    return chosen


class Identifier:
    """Predicts for batches of texts, with a table of log-probabilities."""

    def __init__(self, langs: list[str], table: np.ndarray) -> None:
        self.langs, self.table, self.alphabet = langs, table, _alphabet()

    def run(self, texts: list[str]) -> Iterator[np.ndarray | None]:
        for a, b in _runs(texts):
            yield from self._shares(texts[a:b])

    def _shares(self, texts: list[str]) -> Iterator[np.ndarray | None]:
        letters, ends = _letters(texts, self.alphabet)
        at, cells = _trigrams(letters)
        if not len(at) or not self.langs:
            yield from [None] * len(texts)
            return
        new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
        words = np.add.reduceat(self.table[cells], new, axis=0)
        counts = np.diff(np.concatenate(([0], np.searchsorted(at[new], ends))))
        shares = iter(select_languages(words, counts[counts > 0]))
        for n in counts.tolist():
            yield next(shares) if n else None


def _predictor(langs: list[str], table):
    @pandas_udf("lang_pred string, score double, languages array<string>, shares array<double>")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(langs, table.value)
        for texts in parts:
            rows = []
            for share in identifier.run([t or "" for t in texts]):
                if share is None:
                    rows.append((UNDETERMINED, 0.0, [], []))
                else:
                    order = [k for k in np.argsort(-share, kind="stable").tolist() if share[k] > 0]
                    rows.append((langs[order[0]], min(1.0, float(share[order[0]])), [langs[k] for k in order],
                                 [float(share[k]) for k in order]))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "languages", "shares"])

    return predict


def _with_prediction(docs: DataFrame, model: DataFrame) -> DataFrame:
    langs, table = learn(model)
    predict = _predictor(langs, docs.sparkSession.sparkContext.broadcast(table))
    return docs.withColumn("predicted", predict(F.col("text")))


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages, shares`` of each document.

    ``docs`` has ``doc_id, text, lang``. ``lang_pred`` has the largest share of the selected languages and
    ``score`` is that share; ``languages`` and ``shares`` are all of them, largest first, ties by name.
    ``held_out`` marks the rows that are never learned from because of their ``doc_id``. A text that is NULL or
    has no letter is ``und`` with score 0, and so is every text if no row with a language may be learned
    from. Rows without ``doc_id`` are predicted, not held out, and never learned from. Repeated rows are
    predicted alike. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return _with_prediction(rows, docs).select("doc_id", held_out.alias("held_out"), "predicted.*")


def keep_languages(docs: DataFrame, least_share: float = 0.4) -> DataFrame:
    """The rows whose text has a language that makes up ``least_share`` of it, all columns kept, whatever their names.

    Texts that are NULL, empty or without a letter go. Repeated rows and equal texts are judged alike, a share of just
    ``least_share`` stays. An empty table stays empty.
    """
    langs, table = learn(docs)
    predict = _predictor(langs, docs.sparkSession.sparkContext.broadcast(table))
    rows = docs.select(F.struct(*docs.columns).alias("row"), predict(F.col("text").cast("string")).alias("predicted"))
    return rows.where((F.col("predicted.lang_pred") != UNDETERMINED) & (F.col("predicted.score") >= least_share)).select("row.*")
