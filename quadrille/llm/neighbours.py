"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut in balanced parts, by recursive bisection along its
slowest mode and swaps that lower the cut. A small classifier learns the part of a vector. Every row of the
table goes to its most probable part; a query goes to several most probable ones, as many as give the wanted
recall for vectors held out of training against all rows, and all rows of those parts are ranked by their exact
inner products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quadrille.session import stage

#: Vectors that partition and classifier are learned from, at most, in order of a hash of ``vec_id``.
SAMPLE = 4_096
#: Further vectors, at most, that tell how many parts to probe, or an eighth of a small table; with fewer than the
#: least number all parts are probed.
HELD, LEAST_HELD = 256, 32
#: Rows of a part, about; there are 8 to 256 parts, a power of two.
ROWS_PER_PART = 4_096
#: Neighbours of a vertex of the graph, and the recall wanted on vectors held out of training.
DEGREE, RECALL = 16, 0.95
#: Rows of a part, and queries that probe it, that meet in one task, about.
SLAB, QUERIES = 16_384, 2_048
#: Queries that are compared at a time, and ties whose exact scores are taken at a time.
FEW, TIES = 128, 1 << 16
HIDDEN, EPOCHS, RATE, BATCH = 128, 25, 0.003, 256


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """A symmetric 0/1 matrix: each vector and the ``degree`` others of largest inner product."""
    degree = min(degree, len(x) - 1)
    graph = np.zeros((len(x), len(x)), np.float32)
    for at in range(0, len(x) if degree > 0 else 0, 256):
        rows = np.arange(at, min(at + 256, len(x)))
        scores = x[rows] @ x.T
        scores[rows - at, rows] = -np.inf
        near = np.argpartition(-scores, degree - 1, axis=1)[:, :degree]
        graph[rows[:, None], near] = graph[near, rows[:, None]] = 1.0
    return graph


def _halves(graph: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A balanced cut: the larger half of the slowest mode of the graph, then swaps across the cut."""
    n = len(graph)
    walk = graph / np.maximum(graph.sum(axis=1), 1.0)[:, None]
    mode = rng.standard_normal(n).astype(np.float32)
    for _ in range(60):
        mode = mode + walk @ mode
        mode -= mode.mean()
        mode /= np.linalg.norm(mode) + 1e-12
    side = np.full(n, -1.0, np.float32)
    side[np.argsort(mode, kind="stable")[n // 2 :]] = 1.0
    for _ in range(20):
        gain = -side * (graph @ side)
        a, b = (np.flatnonzero(side == s) for s in (-1.0, 1.0))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        k = min(len(a), len(b), max(1, n // 50))
        swap = np.flatnonzero(gain[a[:k]] + gain[b[:k]] > 2.0)
        if not len(swap):
            break
        side[a[swap]], side[b[swap]] = 1.0, -1.0
    return side > 0


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    label = np.zeros(len(graph), np.int64)
    size = 1
    while size < parts:
        for part in range(size):
            rows = np.flatnonzero(label == part)
            if len(rows) > 1:
                label[rows[_halves(graph[np.ix_(rows, rows)], rng)]] += size
        size *= 2
    return label


class Router:
    """A classifier with one hidden layer: the log-probability of each part for a vector."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int, rng: np.random.Generator) -> None:
        self.scale = float(np.sqrt((x**2).mean())) or 1.0
        sizes = (x.shape[1], HIDDEN, parts)
        self.w = [rng.standard_normal((a, b)) * np.sqrt(2 / a) for a, b in zip(sizes, sizes[1:])]
        self.b = [np.zeros(b) for b in sizes[1:]]
        first, second = ([np.zeros_like(p) for p in self.w + self.b] for _ in range(2))
        step = 0
        x = x / self.scale
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                step += 1
                hidden = np.maximum(x[rows] @ self.w[0] + self.b[0], 0)
                error = np.exp(self._log_softmax(hidden @ self.w[1] + self.b[1]))
                error[np.arange(len(rows)), label[rows]] -= 1
                error /= len(rows)
                back = (error @ self.w[1].T) * (hidden > 0)
                slopes = [x[rows].T @ back + 1e-4 * self.w[0], hidden.T @ error + 1e-4 * self.w[1],
                          back.sum(axis=0), error.sum(axis=0)]
                for p, g, m, v in zip(self.w + self.b, slopes, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _log_softmax(z: np.ndarray) -> np.ndarray:
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """The parts of each vector, most probable first, ties to the smaller number."""
        hidden = np.maximum(x / self.scale @ self.w[0] + self.b[0], 0)
        return np.argsort(-(hidden @ self.w[1] + self.b[1]), axis=1, kind="stable")


class Index:
    """What the tasks need to route vectors: it depends on the sample, not on the size of the table."""

    def __init__(self, sample: np.ndarray, rows: int) -> None:
        rng = np.random.default_rng(11)
        self.parts = 8
        while self.parts < 256 and self.parts * ROWS_PER_PART < rows:
            self.parts *= 2
        self.probes = self.parts
        label = balanced_parts(neighbour_graph(sample, DEGREE), self.parts, rng)
        self.router = Router(sample, label, self.parts, rng)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _best_of_few(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    scores = queries @ rows.T
    scores[query_ids[:, None] == row_ids[None, :]] = -np.inf
    k_here = min(k, scores.shape[1])
    least = np.partition(scores, scores.shape[1] - k_here, axis=1)[:, scores.shape[1] - k_here]
    # Rounding of the product of matrices must not decide between rows as near as this.
    q, r = np.nonzero((scores >= (least - 1e-9 * np.maximum(1.0, np.abs(least)))[:, None]) & np.isfinite(scores))
    del scores
    exact = np.empty(len(q))
    for at in range(0, len(q), TIES):
        some = slice(at, at + TIES)
        exact[some] = (queries[q[some]] * rows[r[some]]).sum(axis=1)
    order = np.lexsort((row_ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return query_ids[q[keep]], row_ids[r[keep]], exact[keep]


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """For each query its ``k`` best rows of a block, other than itself: query, row, exact score.

    A few queries are compared with all rows at a time, so that memory holds even where every row ties.
    """
    found = [_best_of_few(queries[at : at + FEW], query_ids[at : at + FEW], rows, row_ids, k) for at in range(0, len(queries), FEW)]
    return tuple(np.concatenate(x) for x in zip(*found))


def tiles(routed: DataFrame, is_query) -> tuple[DataFrame, DataFrame]:
    """Queries and rows, each with the ``part, slab, block`` in which they meet.

    A part with many rows has several slabs, one with many queries several blocks. A row goes to the blocks of its own part,
    a query to the slabs of the parts that it probes, and parts that no query probes are left out. What is counted
    beforehand is one number a part.
    """
    queries = routed.where(is_query).select("vec_id", "vector", F.explode("parts").alias("part"))
    rows = routed.select("vec_id", "vector", F.col("parts")[0].alias("part"))

    def pieces_of(counted: DataFrame, size: int) -> Column:
        found = {r["part"]: -(-r["count"] // size) for r in counted.groupBy("part").count().collect()}
        return F.array(*[F.lit(found.get(part, 0)) for part in range(max(found, default=0) + 1)])

    slabs, blocks = pieces_of(rows, SLAB), pieces_of(queries, QUERIES)
    of_part = lambda numbers: F.coalesce(F.get(numbers, F.col("part")), F.lit(0))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    right = rows.where(of_part(blocks) > 0).select(
        "part", F.pmod(F.xxhash64("vec_id"), of_part(slabs)).cast("int").alias("slab"), every(of_part(blocks)).alias("block"),
        "vec_id", F.col("vector").alias("of_row"))
    left = queries.where(of_part(slabs) > 0).select(
        "part", every(of_part(slabs)).alias("slab"), F.pmod(F.xxhash64("vec_id", "part"), of_part(blocks)).cast("int").alias("block"),
        F.col("vec_id").alias("query_id"), F.col("vector").alias("of_query"))
    return left, right


def _search(k: int):
    """The best rows of a slab for each query of a block, both of one part."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, r, s = best_of_block(_matrix(left["of_query"]), left["query_id"].to_numpy(),
                                _matrix(right["of_row"]), right["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": q, "vec_id": r, "score": s})

    return run


def probes_for(rows: DataFrame, count: int, router: Router, ids: np.ndarray, held: np.ndarray, k: int, wanted: float) -> int:
    """How many parts a query must see for the wanted recall: held-out queries against all rows.

    The mean over the queries, less two standard errors, reaches ``wanted``.
    """
    ranked = router.ranked(held)

    def near(slab: pd.DataFrame) -> pd.DataFrame:
        x, row_ids = _matrix(slab["vector"]), slab["vec_id"].to_numpy()
        q, r, score = best_of_block(held, ids, x, row_ids, k)
        order = np.argsort(row_ids)
        home = router.ranked(x)[:, 0][order[np.searchsorted(row_ids, r, sorter=order)]]
        return pd.DataFrame({"query_id": q, "vec_id": r, "score": score, "home": home})

    slab = F.pmod(F.xxhash64("vec_id"), F.lit(-(-count // SLAB)))
    found = rows.groupBy(slab.alias("slab")).applyInPandas(near, "query_id long, vec_id long, score double, home int")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # At most k rows of each held-out query.
    best = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "home").toPandas()
    number = {q: n for n, q in enumerate(ids.tolist())}
    place = np.argsort(ranked, axis=1, kind="stable")
    seen = np.zeros(ranked.shape)
    at = best["query_id"].map(number).to_numpy()
    np.add.at(seen, (at, place[at, best["home"].to_numpy()]), 1.0)
    recall = np.cumsum(seen, axis=1) / np.maximum(seen.sum(axis=1, keepdims=True), 1.0)
    least = recall.mean(axis=0) - 2 * recall.std(axis=0) / np.sqrt(len(held))
    enough = np.flatnonzero(least >= wanted)
    return int(enough[0]) + 1 if len(enough) else ranked.shape[1]


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, vector``: one row per ``vec_id``, without vectors that are NULL, zero or not finite."""
    vector = F.col("embedding").cast("array<double>")
    good = (
        F.col("vec_id").isNotNull() & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.coalesce(good, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def nearest_neighbours(table: DataFrame, is_query, k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query, nearest first.

    ``table`` has ``vec_id, embedding``; ``is_query`` is a condition on ``vec_id``. Nearness is the inner product
    in double precision, ties go to the smaller ``vec_id``. Rows without ``vec_id`` and vectors that are NULL,
    empty, zero or hold a NULL or non-finite number take no part, nor do vectors of another length than
    most; of rows that share a ``vec_id`` the least vector counts. Other columns are ignored. With fewer than two usable
    rows the result is empty.
    """
    spark = table.sparkSession
    rows = usable(table)
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    rows = rows.where(F.size("vector") == lengths["d"])
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample + HELD).select("vec_id", "vector").collect()
    learned = len(chosen) - min(HELD, len(chosen) // 8)
    index = Index(_matrix(r["vector"] for r in chosen[:learned]), lengths["n"])
    router = index.router
    # Copies of each other are one query, copies of what the router has seen are none.
    known, held = {tuple(r["vector"]) for r in chosen[:learned]}, {}
    for r in chosen[learned:]:
        if (vector := tuple(r["vector"])) not in known:
            held.setdefault(vector, r["vec_id"])
    if len(held) >= LEAST_HELD:
        index.probes = probes_for(rows, lengths["n"], router, np.array(list(held.values()), np.int64), _matrix(held), k, RECALL)

    @pandas_udf("array<int>")
    def parts_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(router.ranked(_matrix(vectors))[:, : index.probes].astype(np.int32)))

    routed = stage(rows.withColumn("parts", parts_of("vector")), "routed")
    left, right = tiles(routed, is_query)
    where = ["part", "slab", "block"]
    found = left.groupBy(*where).cogroup(right.groupBy(*where)).applyInPandas(
        _search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
