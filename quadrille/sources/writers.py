"""Writers: N-Triples, N-Quads, SPARQL results JSON and the quad table itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import nt_iri, nt_term
from ..schema import QUAD_COLS, XSD_STRING, same_row, statement_set
from ..session import dropped_shuffles, stage


def _triple() -> list[Column]:
    return [nt_term("s", "s_type"), nt_iri("p"), nt_term("o", "o_type", "o_datatype", "o_lang")]


def to_ntriples(quads: DataFrame) -> DataFrame:
    """One line per statement, in column ``value``. The graph is not written."""
    return quads.select(F.concat_ws(" ", *_triple(), F.lit(".")).alias("value"))


def to_nquads(quads: DataFrame) -> DataFrame:
    """One line per statement with its graph, in column ``value``."""
    graph = F.when(F.col("g").isNotNull(), nt_iri("g"))
    return quads.select(F.concat_ws(" ", *_triple(), graph, F.lit(".")).alias("value"))


#: A compressed file is read by one task, so it gets no more lines than this.
FILE_LINES = 1 << 16


def _write_lines(lines: DataFrame, path: str, mode: str, compression: str | None) -> None:
    writer = lines.write.mode(mode)
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_LINES)
    with dropped_shuffles(lines.sparkSession):
        writer.text(path)


def write_ntriples(quads: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Text files of lines; with a ``compression`` that Spark knows, such as ``gzip``, in files of at most ``FILE_LINES``."""
    _write_lines(to_ntriples(quads), path, mode, compression)


def write_nquads(quads: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """As ``write_ntriples``, each line with its graph."""
    _write_lines(to_nquads(quads), path, mode, compression)


def _binding(variables: Sequence[str]) -> Column:
    """A solution as a JSON object; unbound variables are absent, ``xsd:string`` is not written."""
    return F.struct(
        *[
            F.when(
                F.col(v).isNotNull(),
                F.struct(
                    F.col(f"{v}_type").alias("type"),
                    F.when(
                        F.col(f"{v}_lang").isNull() & (F.col(f"{v}_datatype") != XSD_STRING),
                        F.col(f"{v}_datatype"),
                    ).alias("datatype"),
                    F.col(f"{v}_lang").alias("xml:lang"),
                    F.col(v).alias("value"),
                ),
            ).alias(v)
            for v in variables
        ]
    )


def to_solution_json(solutions: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One JSON object per solution in column ``value``: the scalable, line-by-line form."""
    others = [
        c for c in solutions.columns
        if not any(c in (v, f"{v}_type", f"{v}_datatype", f"{v}_lang") for v in variables)
    ]
    return solutions.select(*others, F.to_json(_binding(variables)).alias("value"))


def to_results_json(
    solutions: DataFrame, variables: Sequence[str], key: str, order: str | None = None
) -> DataFrame:
    """One SPARQL results document per ``key`` in column ``body``.

    A document is one cell, so this form is for results of a size that one response may have; use
    :func:`to_solution_json` for results of any size.
    """
    rows = to_solution_json(solutions, variables)
    at = F.col(order) if order else F.col("value")
    docs = rows.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("value").alias("value")))).alias("rows")
    )
    head = '{"head":{"vars":[' + ",".join(f'"{v}"' for v in variables) + ']},"results":{"bindings":['
    bindings = F.array_join(F.transform("rows", lambda r: r["value"]), ",")
    return docs.select(key, F.concat(F.lit(head), bindings, F.lit("]}}")).alias("body"))


def write_results_json(solutions: DataFrame, variables: Sequence[str], path: str) -> None:
    to_solution_json(solutions, variables).select("value").write.text(path)


# --- the quad store -------------------------------------------------------------------------------------------

#: Buckets of graphs that a store begins with, rows of a bucket before it is split, and the most halvings of all graphs.
DEFAULT_BUCKETS, BUCKET_ROWS, MOST_DEPTH = 16, 1 << 26, 16
_BUCKET = ["g_depth", "g_slot"]
_LAYOUT = "g_depth int, g_slot int, n_rows bigint, n_graphs bigint, n_cells int, of int"


def graph_bucket(g: str | Column, buckets: int) -> Column:
    c = F.col(g) if isinstance(g, str) else g
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


class Layout:
    """The buckets of a store. Bucket ``(depth, slot)`` holds the graphs whose hash ends in the ``depth`` bits of ``slot``; one
    that has been split is not there any more, its folder is left to whoever still reads it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        version = F.regexp_extract(F.col("_metadata.file_path"), "/v([0-9]{6})/", 1).cast("int").alias("version")
        rows = spark.read.schema(_LAYOUT).json(f"{path}/_layout/*").select("*", version).collect()
        whole = [r for r in rows if r["of"] == sum(r["version"] == o["version"] for o in rows)]
        self.version = max((r["version"] for r in whole), default=-1)
        self.rows = sorted((r for r in whole if r["version"] == self.version), key=lambda r: (r["g_depth"], r["g_slot"]))

    def slots(self) -> dict[int, list[int]]:
        """Live slots by depth."""
        out: dict[int, list[int]] = {}
        for r in self.rows:
            out.setdefault(r["g_depth"], []).append(r["g_slot"])
        return out

    def is_live(self) -> Column:
        """A condition on the folders alone; it names the few that were split."""
        split = {(d, r["g_slot"] % 2**d) for r in self.rows for d in range(r["g_depth"])}
        by_depth: dict[int, list[int]] = {}
        for depth, slot in split:
            by_depth.setdefault(depth, []).append(slot)
        return ~_any([(F.col("g_depth") == d) & F.col("g_slot").isin(sorted(s)) for d, s in sorted(by_depth.items())])

    def holds(self, graphs: list[Column]) -> Column:
        """A condition on the folders alone: those that hold one of the graphs, whatever their depth."""
        return _any([(F.col("g_depth") == d) & F.col("g_slot").isin([graph_bucket(g, 2**d) for g in graphs]) for d in self.slots()])

    def depth_of(self, g: str) -> Column:
        """The depth of the bucket that a graph belongs to."""
        depth = F.lit(None).cast("int")
        for d, slots in self.slots().items():
            depth = F.when(graph_bucket(g, 2**d).isin(slots), d).otherwise(depth)
        return depth


def _write_buckets(quads: DataFrame, path: str, depth: Column, mode: str = "errorifexists") -> None:
    placed = quads.select(*QUAD_COLS, depth.alias("g_depth")).withColumn(
        "g_slot", F.pmod(F.xxhash64("g"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("g_depth"))).cast("int"))
    clustered = placed.repartitionByRange(*_BUCKET, "p", "s", F.xxhash64("o")).sortWithinPartitions(*_BUCKET, "p", "s")
    with dropped_shuffles(quads.sparkSession):
        clustered.write.mode(mode).partitionBy(*_BUCKET).parquet(path)


def _table(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join([*(f"{c} string" for c in QUAD_COLS), *(f"{c} int" for c in _BUCKET)])
    return spark.read.schema(schema).parquet(path)


def _settle(spark: SparkSession, path: str, version: int, live: Column, bucket_rows: int) -> None:
    """Split the buckets that have grown too large, and write the layout that from then on holds.

    The counts are those of the finest halving, at most ``2 ** MOST_DEPTH`` rows whatever the size of the store. A
    bucket is split while it holds too much and more than one cell of that halving; only its rows are written again.
    """
    cells = _table(spark, path).where(live).groupBy(*_BUCKET, graph_bucket("g", 2**MOST_DEPTH).alias("cell")).agg(
        F.count("*").alias("n"), F.approx_count_distinct(F.coalesce("g", F.lit(""))).alias("graphs")).collect()
    buckets: dict[tuple[int, int], list] = {}
    for c in cells:
        buckets.setdefault((c["g_depth"], c["g_slot"]), []).append(c)
    grown: dict[tuple[int, int], int] = {}
    final = {}
    open_ = [(key, key) for key in buckets]
    while open_:
        (depth, slot), origin = open_.pop()
        held = [c for c in buckets[origin] if c["cell"] % 2**depth == slot]
        if not held:
            continue
        if sum(c["n"] for c in held) > bucket_rows and len(held) > 1 and depth < MOST_DEPTH:
            grown[origin] = 1
            open_ += [((depth + 1, slot), origin), ((depth + 1, slot + 2**depth), origin)]
        else:
            final[depth, slot] = (sum(c["n"] for c in held), sum(c["graphs"] for c in held), len(held))
    if grown:
        moved = _table(spark, path).where(live).where(_any([(F.col("g_depth") == d) & (F.col("g_slot") == s) for d, s in grown]))
        parts = {(d, s) for d, s in final if any(d > od and s % 2**od == os for od, os in grown)}
        depth = F.lit(None).cast("int")
        for d in sorted({d for d, _ in parts}):
            depth = F.when(graph_bucket("g", 2**d).isin([s for e, s in parts if e == d]), d).otherwise(depth)
        _write_buckets(moved, path, depth, "append")
    rows = [(d, s, *counts, len(final)) for (d, s), counts in final.items()]
    spark.createDataFrame(rows, _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{path}/_layout/v{version:06d}")


def write_quads(
    quads: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS, is_set: bool = False, bucket_rows: int = BUCKET_ROWS
) -> None:
    """Store a set of quads as Parquet, by graph bucket, clustered by predicate and subject.

    The range partitioning cuts inside a bucket as well, so one graph with most of the rows is still
    written by many tasks, and row-group statistics on ``p`` and ``s`` stay narrow. The store keeps its own layout,
    with the rows and graphs of each bucket: it begins with ``buckets``, up to the next power of two, and a bucket of
    more than ``bucket_rows`` is split in halves for as long as it has more than one graph to part.
    """
    spark = quads.sparkSession
    depth = max(0, min(MOST_DEPTH, (buckets - 1).bit_length()))
    _write_buckets(statement_set(quads, is_set=is_set), path, F.lit(depth))
    _settle(spark, path, 0, F.lit(True), bucket_rows)


def append_quads(quads: DataFrame, path: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Add quads to a store; those that it holds already are left out. Buckets that have grown too large are split."""
    spark = quads.sparkSession
    layout = Layout(spark, path)
    # A graph that no bucket holds yet opens one at the depth of its neighbours.
    first = min(layout.slots(), default=(DEFAULT_BUCKETS - 1).bit_length())
    depth = F.coalesce(layout.depth_of("g"), _free_depth(layout, first))
    new = stage(statement_set(quads), "new-quads")
    graphs = new.select(F.col("g").alias("_added")).distinct()
    stored = read_quads(spark, path).join(graphs, F.col("g").eqNullSafe(F.col("_added")), "left_semi").alias("l")
    new = new.alias("r").join(stored, same_row("r", "l", QUAD_COLS), "left_anti")
    _write_buckets(new, path, depth, "append")
    _settle(spark, path, layout.version + 1, layout.is_live(), bucket_rows)


def _free_depth(layout: Layout, first: int) -> Column:
    """The least depth at which the bucket of a graph is neither split nor begun."""
    split = {(d, r["g_slot"] % 2**d) for r in layout.rows for d in range(r["g_depth"])}
    depth = F.lit(MOST_DEPTH)
    for d in range(MOST_DEPTH, first - 1, -1):
        taken = sorted(s for e, s in split if e == d)
        depth = F.when(~graph_bucket("g", 2**d).isin(taken) if taken else F.lit(True), d).otherwise(depth)
    return depth


def read_quads(spark: SparkSession, path: str, graphs: Sequence[str | None] | None = None) -> DataFrame:
    """Scan a stored quad table; with ``graphs`` only the buckets that may hold them are listed."""
    layout = Layout(spark, path)
    table = _table(spark, path).where(layout.is_live())
    if graphs is not None:
        named = [g for g in graphs if g is not None]
        holds = F.col("g").isin(named) if named else F.lit(False)
        if None in graphs:
            holds = holds | F.col("g").isNull()
        # The first condition is on the directories alone, the second one on what they hold.
        table = table.where(layout.holds([F.lit(g).cast("string") for g in graphs])).where(holds)
    return table.select(*QUAD_COLS)
