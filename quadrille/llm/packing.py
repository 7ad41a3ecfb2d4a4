"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

A sequence holds ``capacity`` tokens, so documents of one length are interchangeable and the whole
instance is a histogram of at most ``capacity`` counts, whatever the number of documents. The driver
reduces and packs the histogram; Spark ranks the pieces of each length and gives rank after rank the
places that the packed patterns have for that length.

The reduction permanently fixes a set of pieces that holds a piece ``j`` when no other feasible set with
``j`` can lead to fewer sequences: ``j`` alone if nothing fits beside it; ``j`` with the piece that fills
the rest exactly; ``j`` with the largest piece that fits if no two do; ``j`` with the two largest that fit
if no three do and every other feasible pair is dominated by these two. What is left is packed by best fit
in order of decreasing length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.session import stage

#: A word of Latin letters, perhaps with one punctuation mark behind it: tokens never join the two.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
#: Entries of the memory of a task for words and their ids.
WORDS_KEPT = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of a stretch of text without blanks as little-endian bytes, found once and kept.

    The tokenizer drops white space and never joins across it, so a text is the sum of its stretches.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.letters = _byte_letters()

    def __missing__(self, text: str) -> bytes:
        plain = PLAIN.fullmatch(text)
        if plain and plain[2]:
            ids = self[plain[1]] + self[plain[2]]
        elif plain and (lower := text.lower()) != text:
            ids = self[lower]
        elif plain:
            word = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            ids = np.array([t.id for t in self.pieces(word)], "<u4").tobytes()
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < WORDS_KEPT:
            self[text] = ids
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = WordIds(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                ids = words.of(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            yield pd.DataFrame({"doc_id": pd.array(out[0], "Int64"), "piece": out[1], "start": out[2],
                                "length": out[3], "ids_crc32": out[4]})

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the ids of each text and the end id, cut at ``capacity``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(
        _cut(tokenizer, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[tuple[int, ...], int]


class Histogram:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.capacity = capacity

    def largest(self, limit: int, without: tuple[int, ...] = ()) -> int:
        """The longest piece of at most ``limit``, other than one of each of ``without``; 0 if none."""
        if limit <= 0:
            return 0
        left = self.left[: limit + 1]
        for length in np.flatnonzero(left)[::-1]:
            if left[length] > without.count(int(length)):
                return int(length)
        return 0

    def smallest(self, k: int, without: int) -> list[int]:
        """The ``k`` shortest pieces other than one of ``without``."""
        out: list[int] = []
        for length in np.flatnonzero(self.left):
            n = int(self.left[length]) - (length == without)
            out += [int(length)] * min(n, k - len(out))
            if len(out) == k:
                break
        return out

    def take(self, pieces: tuple[int, ...]) -> Pattern:
        """Fix this set as often as the pieces are there."""
        n = min(int(self.left[p]) // pieces.count(p) for p in pieces)
        for p in pieces:
            self.left[p] -= n
        return pieces, n


def _dominating(h: Histogram, j: int) -> tuple[int, ...] | None:
    """A set with ``j`` that dominates all others, if one of the tests finds it."""
    rest = h.capacity - j
    best = h.largest(rest, (j,))
    if not best:
        return (j,)
    if best == rest:
        return j, best
    low = h.smallest(3, j)
    if len(low) < 2 or low[0] + low[1] > rest:
        return j, best
    if len(low) == 3 and sum(low) <= rest:
        return None
    second = h.largest(rest - best, (j, best))
    if not second:
        return None
    # Every feasible pair x >= y has x <= best; it is dominated if y <= second, too. The largest y of a
    # pair is at most half the rest, and needs a partner of at least its own length beside it.
    for y in np.flatnonzero(h.left[: rest // 2 + 1])[::-1]:
        y = int(y)
        if h.left[y] - (y == j) >= 1:
            x = h.largest(rest - y, (j, y))
            if x >= y:
                return (j, best, second) if second >= y else None
    return None


def reduce_instance(h: Histogram) -> list[Pattern]:
    """Fix dominating sets until no length has one."""
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for j in range(h.capacity, 0, -1):
            while h.left[j] and (found := _dominating(h, j)):
                fixed.append(h.take(found))
                changed = True
    return fixed


def best_fit(h: Histogram) -> list[Pattern]:
    """Put pieces, longest first, each into the fullest sequence that has room; alike sequences at once."""
    by_room: dict[int, list[Pattern]] = {}
    rooms = np.zeros(h.capacity + 1, np.int64)

    def put(pattern: tuple[int, ...], n: int) -> None:
        room = h.capacity - sum(pattern)
        by_room.setdefault(room, []).append((pattern, n))
        rooms[room] += n

    for length in range(h.capacity, 0, -1):
        left = int(h.left[length])
        while left:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = int(fitting[0]) + length
                pattern, n = by_room[room].pop()
                used = min(n, left)
                rooms[room] -= n
                if used < n:
                    put(pattern, n - used)
            else:
                pattern, used = (), left
                each = h.capacity // length
                if each > 1 and left > each:
                    # New sequences of this length alone would fill up one after the other.
                    put((length,) * each, left // each)
                    left %= each
                    continue
                used = min(used, 1) if each > 1 else left
            put(pattern + (length,), used)
            left -= used
        h.left[length] = 0
    return [p for patterns in by_room.values() for p in patterns]


def pack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Sequences as ``(lengths of the pieces, how many such sequences)``."""
    h = Histogram(counts, capacity)
    return reduce_instance(h) + best_fit(h)


def _places(patterns: list[Pattern]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, sequences, offset``, sorted by length and rank."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for pieces, n in patterns:
        offset = 0
        for length in dict.fromkeys(pieces):
            m = pieces.count(length)
            rows.append((length, rank.get(length, 0), base, n, offset))
            rank[length] = rank.get(length, 0) + n * m
            offset += length * m
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _assign(places):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = places.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch.pop("rank").to_numpy(np.int64)
            row = table[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            k = rank - row[:, 1]
            n = np.maximum(row[:, 3], 1)
            yield batch.assign(doc_id=batch["doc_id"].astype("Int64"), sequence_id=row[:, 2] + k % n,
                               offset=row[:, 4] + length * (k // n))

    return run


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens.

    Takes ``doc_id`` and ``text`` of ``docs``; ``tokenizer`` is the path of a tokenizer file that every
    executor has. Returns one row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Only a document longer than ``capacity`` (its end id included) is cut.

    A NULL or empty text is the end id alone. Repeated rows and rows without ``doc_id`` are packed like any
    other. Other columns are ignored. An empty table gives an empty result. Which of the pieces of one
    length gets which place is open; their order in the written table decides it.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id)
                   .withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(pack(counts, capacity)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) >> 20)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = (
        dealt.groupBy("bucket", "length").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    ranked = dealt.join(before, ["bucket", "length"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("bucket", "length").orderBy("row")) - 1)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        _assign(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
