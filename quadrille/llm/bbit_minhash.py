"""Near-duplicate documents by b-bit MinHash.

1. Each document is its set of word shingles. The set goes through universal hash permutations; of the least value of
   each permutation only the lowest ``BITS`` bits are kept, packed into words of 64 bits, and hashes of ``ROWS`` full
   values in a row are the bands. Equal sets are one class, whatever their number.
2. Classes that meet in a band, directly or over others, make up a family of candidates.
3. Within a family, packed signatures are compared by exclusive or and bit counts. The share of equal fields, less
   what is equal by chance, estimates the similarity; what is too far below the threshold falls apart, which leaves
   narrower families.
4. Within those, pairs that pass the estimate are confirmed on their full sets.

Families are dealt over blocks of bounded size, and each pair of blocks is one task, so a family is never one group of
one task. A task walks from row to row and looks only at rows that share a band with it and were not reached yet: a thousand near
copies cost about a thousand comparisons and give a thousand links, not their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm import shingles
from quadrille.llm.components import connected
from quadrille.session import stage

#: Minima kept of each set, bits kept of each minimum, and minima of one band. At a similarity of 0.85 a pair meets in
#: none of the 32 bands with a chance of about 7e-9; at 0.3 it meets with one of 0.07.
PERMUTATIONS, BITS, ROWS = 160, 2, 5
#: Chance that a pair at the threshold fails the estimate.
MISS = 1e-9
#: Rows of one block of signatures, and shingles of one block of full sets.
BLOCK_ROWS, BLOCK_ELEMENTS = 1 << 12, 1 << 18
#: So many ids of documents, 16 bytes each, may be broadcast to fetch their texts; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 21


class BBitMinHash:
    """Packed low bits of minima, and bands of full minima, for sets of 64-bit shingle hashes."""

    def __init__(self, permutations: int = PERMUTATIONS, bits: int = BITS, rows: int = ROWS) -> None:
        if bits not in (1, 2, 4, 8) or permutations * bits % 64:
            raise ValueError("bits must be 1, 2, 4 or 8, and fill whole words of 64 bits")
        self.bits, self.rows = bits, rows
        seeds = shingles.mix(np.arange(2 * permutations, dtype=np.uint64) + np.uint64(0x3C6EF372FE94F82B))
        self.a, self.b = seeds[:permutations] | np.uint64(1), seeds[permutations:]

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 32-bit values per set, which must not be empty.

        Of a product modulo 2 ** 64 the upper half is kept: its lower bits depend on few bits of the factor.
        """
        x = np.concatenate(sets)
        first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
        out = np.empty((len(sets), len(self.a)), np.uint32)
        v = np.empty_like(x)
        for i in range(len(self.a)):
            np.multiply(x, self.a[i], out=v)
            np.add(v, self.b[i], out=v)
            out[:, i] = np.minimum.reduceat(v, first) >> np.uint64(32)
        return out

    def pack(self, minima: np.ndarray) -> np.ndarray:
        """The low bits of the minima side by side in words of 64 bits."""
        fields = 64 // self.bits
        low = (minima & np.uint32((1 << self.bits) - 1)).astype(np.uint64).reshape(len(minima), -1, fields)
        shifts = np.arange(fields, dtype=np.uint64) * np.uint64(self.bits)
        return np.bitwise_or.reduce(low << shifts, axis=2)

    def bands(self, minima: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(self.a) - self.rows + 1, self.rows):
            band = np.full(len(minima), i + 1, np.uint64)
            for j in range(i, i + self.rows):
                band = shingles.mix(band ^ minima[:, j])
            out.append(band)
        return np.stack(out, axis=1).view(np.int64)


def equal_fields(one: np.ndarray, others: np.ndarray, bits: int = BITS) -> np.ndarray:
    """How many fields of a packed signature equal those of each of others, by bit counts."""
    apart = one ^ others
    half = bits >> 1
    while half:
        apart = apart | apart >> np.uint64(half)
        half >>= 1
    fields = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    return others.shape[1] * (64 // bits) - np.bitwise_count(apart & fields).sum(axis=1, dtype=np.int64)


def similarity(equal: np.ndarray, permutations: int = PERMUTATIONS, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity: the share of equal fields, corrected for those equal by chance."""
    chance = 0.5**bits
    return (equal / permutations - chance) / (1 - chance)


def least_equal(percent: int, permutations: int = PERMUTATIONS, bits: int = BITS, miss: float = MISS) -> int:
    """The equal fields that a pair at the threshold has, but for a chance of ``miss``: a binomial quantile."""
    p = 0.5**bits + (1 - 0.5**bits) * percent / 100
    if p >= 1:
        return permutations
    below = 0.0
    for k in range(permutations + 1):
        below += math.exp(math.lgamma(permutations + 1) - math.lgamma(k + 1) - math.lgamma(permutations - k + 1)
                          + k * math.log(p) + (permutations - k) * math.log(1 - p))
        if below > miss:
            return k
    return permutations


def forest(bands: np.ndarray, linked: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """The first row of the tree of each row; ``linked(i, others)`` says which of ``others`` link with row ``i``.

    Only rows that share a band with row ``i`` and are not reached yet are asked for, which is all that trees need.
    """
    n, width = bands.shape
    order = np.argsort(bands, axis=None, kind="stable")
    sorted_bands = bands.ravel()[order]
    begin = np.flatnonzero(np.concatenate(([True], sorted_bands[1:] != sorted_bands[:-1])))
    rows_of = np.split(order // width, begin[1:])
    bucket = np.empty(n * width, np.int64)
    bucket[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    shared = np.array([len(r) > 1 for r in rows_of])
    buckets = [b[shared[b]].tolist() for b in bucket.reshape(n, width)]
    root, free = np.arange(n), np.ones(n, bool)
    for start in range(n):
        if not free[start]:
            continue
        free[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            met = []
            for b in buckets[i]:
                # Rows that were reached leave a bucket once and for all.
                if len(rows_of[b]):
                    rows_of[b] = rows_of[b][free[rows_of[b]]]
                    met.append(rows_of[b])
            others = np.unique(np.concatenate(met)) if met else order[:0]
            if len(others):
                new = others[linked(i, others)]
                free[new] = False
                root[new] = start
                queue.extend(new.tolist())
    return root


def _describe(width: int, permutations: int, bits: int, rows: int):
    """Size and key of each document; of the first of equal sets in a run also signature and bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, minhash = shingles.Hasher(), BBitMinHash(permutations, bits, rows)
        for batch in batches:
            texts = [t or b"" for t in batch["text"]]
            ids, tids = batch["doc_id"].astype("Int64"), batch["tid"].astype("Int64")
            for a, b in shingles.runs(texts):
                sets = [shingles.distinct(s) for s in hasher.shingles(texts[a:b], width)]
                keys = [shingles.set_key(s) for s in sets]
                new = [i for i in {k: i for i, k in reversed(list(enumerate(keys)))}.values() if len(sets[i])]
                signature: list = [None] * len(sets)
                bands: list = [None] * len(sets)
                if new:
                    minima = minhash.minima([sets[i] for i in new])
                    for i, s, t in zip(new, minhash.pack(minima), minhash.bands(minima)):
                        signature[i], bands[i] = s.tobytes(), t
                yield pd.DataFrame({"doc_id": ids.iloc[a:b].array, "tid": tids.iloc[a:b].array,
                                    "n": [len(s) for s in sets], "key": keys, "signature": signature, "bands": bands})

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = shingles.Hasher()
        for batch in batches:
            texts = [t or b"" for t in batch["text"]]
            for a, b in shingles.runs(texts):
                sets = [shingles.distinct(s) for s in hasher.shingles(texts[a:b], width)]
                yield pd.DataFrame({"key": [shingles.set_key(s) for s in sets], "grams": [s.tobytes() for s in sets]})

    return run


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _bands(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64)


def _estimate(least: int, bits: int):
    """Trees of the rows of a tile whose signatures are near enough."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        packed = _signatures(group["signature"])
        root = forest(_bands(group["bands"]), lambda i, rest: equal_fields(packed[i], packed[rest], bits) >= least)
        keys = group["key"].to_numpy()
        return pd.DataFrame({"u": keys, "v": keys[root]})

    return run


def _confirm(least: int, bits: int, percent: int):
    """Trees of the rows of a tile whose sets link: the estimate first, then the full sets."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        packed = _signatures(group["signature"])
        sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
        sizes = np.array([len(s) for s in sets], np.int64)

        def linked(i: int, rest: np.ndarray) -> np.ndarray:
            out = equal_fields(packed[i], packed[rest], bits) >= least
            # 100 * both >= percent * union needs sizes that are no further apart than that.
            small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
            out &= 100 * small >= percent * large
            near = rest[out]
            if len(near):
                flat = np.concatenate([sets[j] for j in near])
                at = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
                begin = np.concatenate(([0], np.cumsum(sizes[near])[:-1]))
                both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), begin)
                out[out] = 100 * both >= percent * (sizes[i] + sizes[near] - both)
            return out

        root = forest(_bands(group["bands"]), linked)
        keys = group["key"].to_numpy()
        return pd.DataFrame({"u": keys, "v": keys[root]})

    return run


def _whole(families: DataFrame) -> DataFrame:
    """``key, family`` of all members, given ``u, root`` of those that are not the root."""
    roots = families.select(F.col("root").alias("key"), F.col("root").alias("family")).distinct()
    return families.select(F.col("u").alias("key"), F.col("root").alias("family")).unionByName(roots)


def _trees(members: DataFrame, payload: DataFrame, load, per_block: int, tile) -> DataFrame:
    """``u, root`` of the trees that the tiles of all families find together.

    ``members`` has ``key, family`` and what ``load`` sums up; ``payload`` the columns that a tile needs, by ``key``.
    A family of ``b`` blocks has a tile for each two of them, so a row goes to ``b`` tiles.
    """
    blocks = members.groupBy("family").agg(F.ceil(F.sum(load) / per_block).cast("int").alias("blocks"))
    dealt = (
        members.join(blocks, "family")
        .withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "key")
    )
    found = dealt.join(payload, "key").groupBy("family", "lo", "hi").applyInPandas(tile, "u long, v long")
    return connected(found)


def bbit_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, permutations: int = PERMUTATIONS,
                         bits: int = BITS, rows: int = ROWS) -> DataFrame:
    """Groups of documents whose sets of word shingles link: ``100 * shared >= percent * union``.

    Takes ``doc_id`` and ``text`` of ``docs``. Returns one row per document: ``doc_id, n_shingles, component_id, kept``,
    where ``component_id`` is the smallest ``doc_id`` reachable by links and ``kept`` says that it is the document's own.
    Links are confirmed on full sets; a link at the threshold is missed with a chance of about 1e-8.

    A NULL, empty or blank text has no set, links with nothing, is its own component and kept. Repeated rows link with
    each other and are kept or not alike. A row without ``doc_id`` links like any other and takes the smallest ``doc_id``
    of its component; it is kept if there is none. A long text is one set, made from a run of its own. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                         F.xxhash64("text").alias("tid"))
    described = stage(source.mapInPandas(
        _describe(width, permutations, bits, rows),
        "doc_id long, tid long, n long, key long, signature binary, bands array<long>"), "bbit-docs")
    classes = stage(described.where("n > 0").groupBy("key").agg(
        F.min("n").alias("n"), F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "tid")).alias("one"),
        F.max("signature").alias("signature"), F.max("bands").alias("bands")), "bbit-classes")

    # Both sides of the joins below grow with the table, so they are always dealt by key; a hot key is split at run time.
    entries = classes.select("key", F.explode("bands").alias("band"))
    met = entries.groupBy("band").agg(F.min("key").alias("v"), F.max("key").alias("last")).where("v != last")
    candidates = connected(entries.join(met.hint("merge"), "band").select(F.col("key").alias("u"), "v"))

    least = least_equal(percent, permutations, bits)
    members = stage(classes.select("key", "signature", "bands").join(_whole(candidates).hint("merge"), "key"), "bbit-families")
    near = _trees(members.select("key", "family"), members.drop("family"), F.lit(1), BLOCK_ROWS, _estimate(least, bits))

    members = stage(classes.drop("first").join(_whole(near).hint("merge"), "key"), "bbit-families")
    chosen = members.select(F.col("one.doc_id").alias("one_id"), F.col("one.tid").alias("one_tid"))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    sets = (
        source.join(chosen, (F.col("tid") == F.col("one_tid")) & F.col("doc_id").eqNullSafe(F.col("one_id")), "left_semi")
        .select("text").mapInPandas(_full_sets(width), "key long, grams binary").dropDuplicates(["key"])
    )
    payload = stage(sets.join(members.select("key", "signature", "bands"), "key"), "bbit-sets")
    roots = _trees(members.select("key", "family", "n"), payload, F.col("n"), BLOCK_ELEMENTS, _confirm(least, bits, percent))

    groups = stage(classes.join(_whole(roots), "key").select("key", "family", "first"), "bbit-groups")
    smallest = groups.groupBy("family").agg(F.min("first").alias("component"))
    known = classes.select("key", "first").join(
        groups.join(smallest, "family").select("key", "component"), "key", "left"
    ).select("key", F.coalesce("component", "first").alias("component"))
    found = described.select("doc_id", "n", "key").join(known, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
