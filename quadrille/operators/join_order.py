"""Join orders from characteristic sets: which predicates subjects have together, and how often.

Subjects that have the same predicates are one characteristic set. A table of them, with the statements of each
predicate, gives the size of a star (patterns on one subject) without assuming that predicates are independent.
Sizes of stars joined to each other come from the distinct subjects and objects of what they share.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _named() -> Column:
    return F.col("g").isNotNull().alias("named")


def _is_var(item: object) -> bool:
    return isinstance(item, str) and item.startswith("?")


def characteristic_sets(quads: DataFrame) -> DataFrame:
    """``named, predicates, subjects, counts``: of each set of predicates the subjects that have just these, and the
    statements of each predicate on them, apart for the default graph and named graphs (a subject counts once per graph)."""
    node = ["g", "s", "s_type"]
    per = quads.groupBy(_named(), *node, "p").agg(F.count(F.lit(1)).alias("n"))
    nodes = per.groupBy("named", *node).agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("has"))
    nodes = nodes.select("named", F.col("has.p").alias("predicates"), F.explode("has").alias("one"))
    counted = nodes.groupBy("named", "predicates", F.col("one.p").alias("p")).agg(
        F.sum("one.n").alias("n"), F.count(F.lit(1)).alias("subjects"))
    # Every predicate of a set is on each of its subjects.
    return counted.groupBy("named", "predicates").agg(
        F.max("subjects").alias("subjects"), F.map_from_entries(F.collect_list(F.struct("p", "n"))).alias("counts"))


def predicate_statistics(quads: DataFrame) -> DataFrame:
    """``named, p, statements, objects``: the statements of each predicate and, about, their distinct objects."""
    return quads.groupBy(_named(), "p").agg(
        F.count(F.lit(1)).alias("statements"), F.approx_count_distinct("o").alias("objects"))


@dataclass(frozen=True)
class Statistics:
    """Characteristic sets and predicates of a quad table."""

    sets: DataFrame
    predicates: DataFrame

    @staticmethod
    def write(quads: DataFrame, path: str) -> None:
        characteristic_sets(quads).write.mode("overwrite").parquet(f"{path}/sets")
        predicate_statistics(quads).write.mode("overwrite").parquet(f"{path}/predicates")

    @staticmethod
    def read(spark: SparkSession, path: str) -> Statistics:
        return Statistics(spark.read.parquet(f"{path}/sets"), spark.read.parquet(f"{path}/predicates"))


class Estimates:
    """Sizes of joins of some patterns.

    What is brought to the driver is a row per combination of the patterns' own predicates, and one per predicate of them:
    it depends on the patterns, not on the data.
    """

    def __init__(self, patterns: Sequence[tuple], statistics: Statistics) -> None:
        used = sorted({p[1] for p in patterns if not _is_var(p[1])})
        self.at = {p: i for i, p in enumerate(used)}
        kept = F.filter("predicates", lambda x: x.isin(used)) if used else F.array().cast("array<string>")
        sums = [F.sum(F.coalesce(F.col("counts")[p], F.lit(0))).alias(f"n{i}") for p, i in self.at.items()]
        rows = statistics.sets.groupBy("named", kept.alias("kept")).agg(F.sum("subjects").alias("subjects"), *sums).collect()
        self.sets = [(r["named"], set(r["kept"]), r["subjects"], [r[f"n{i}"] for i in range(len(used))]) for r in rows]
        # Of all predicates one row each for the default graph and the named ones.
        known = F.when(F.col("p").isin(used), F.col("p")) if used else F.lit(None).cast("string")
        rows = statistics.predicates.groupBy("named", known.alias("p")).agg(
            *[F.sum(c).alias(c) for c in ("statements", "objects")]).collect()
        self.predicates = {(r["named"], r["p"]): r for r in rows if r["p"] is not None}
        self.total = {
            named: (max(1, sum(r["statements"] for r in rows if r["named"] == named)),
                    max(1, sum(n for scope, _, n, _ in self.sets if scope == named)),
                    max(1, sum(r["objects"] for r in rows if r["named"] == named)))
            for named in (False, True)
        }

    def _objects(self, named: bool, p: str) -> float:
        if _is_var(p):
            return float(self.total[named][2])
        row = self.predicates.get((named, p))
        return float(max(1, row["objects"])) if row else 1.0

    def _star(self, named: bool, predicates: list[str]) -> tuple[float, float]:
        """Solutions of patterns on one free subject, and the subjects that have some."""
        wanted = set(predicates)
        if not wanted:
            return float(self.total[named][1]), float(self.total[named][1])
        size = subjects = 0.0
        for scope, kept, count, counts in self.sets:
            if scope == named and wanted <= kept:
                here = float(count)
                for p in predicates:
                    here *= counts[self.at[p]] / count
                size, subjects = size + here, subjects + count
        return size, subjects

    def size(self, patterns: Sequence[tuple]) -> float:
        """About how many solutions the patterns have together."""
        stars: dict[tuple, list[tuple]] = {}
        for p in patterns:
            stars.setdefault((p[0], p[3] if len(p) > 3 else None), []).append(p)
        out, places = 1.0, {}
        for (subject, graph), star in stars.items():
            named = graph is not None
            here, subjects = self._star(named, [p[1] for p in star if not _is_var(p[1])])
            statements, all_subjects, _ = self.total[named]
            for p in star:
                if _is_var(p[1]):
                    here *= statements / all_subjects
                if _is_var(p[2]):
                    places.setdefault(p[2], []).append(self._objects(named, p[1]))
                else:
                    here /= self._objects(named, p[1])
            if _is_var(subject):
                places.setdefault(subject, []).append(max(1.0, subjects))
            else:
                here /= max(1.0, subjects)
            out *= here
        for distinct in places.values():
            for n in sorted(distinct)[1:]:
                out /= n
        return out


def order_by_size(patterns: Sequence[tuple], statistics: Statistics, after: Sequence[tuple] = ()) -> list[tuple]:
    """The patterns so that each join is estimated to give the fewest solutions, each sharing a variable with those before.

    ``after`` are patterns that are joined already. Of equal estimates the first pattern comes first.
    """
    if not patterns:
        return []
    estimates = Estimates([*after, *patterns], statistics)
    names = lambda p: {t for t in p if _is_var(t)}
    done, rest, out = list(after), list(patterns), []
    while rest:
        bound = set().union(*[names(p) for p in done])
        near = [p for p in rest if bound & names(p)] if done else rest
        if not near:
            raise ValueError("patterns share no variable; their product is not built")

        def cost(p: tuple) -> tuple[float, float]:
            own = estimates.size([*done, p])
            # The first pattern is one of the pair with the fewest solutions.
            pairs = [] if done else [estimates.size([p, q]) for q in rest if q is not p and names(p) & names(q)]
            return min(pairs, default=own), own

        best = min(near, key=cost)
        rest.remove(best)
        done.append(best)
        out.append(best)
    return out
