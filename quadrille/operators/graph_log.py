"""Replay of a log of graph-store operations.

``ops``: ``seq`` (unique, rising), ``op`` (GET, DELETE, POST, PUT), ``g``. ``payload``: triple columns
keyed by ``seq``. PUT replaces a graph, POST adds to it, DELETE drops it, GET reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import QUAD_COLS, TRIPLE_COLS, statement_set
from ..session import stage
from .scans import DEFAULT_BLOCK, block_of, running

_RESETS = ("PUT", "DELETE")
_ADDS = ("PUT", "POST")


def _writes(ops: DataFrame, payload: DataFrame) -> DataFrame:
    """Payload statements with the graph of their operation."""
    adds = ops.where(F.col("op").isin(*_ADDS)).select("seq", "g")
    return payload.select("seq", *TRIPLE_COLS).join(adds, "seq").select("seq", *QUAD_COLS)


def last_resets(ops: DataFrame) -> DataFrame:
    """Per graph the last operation that emptied it: one row each, combined before the shuffle."""
    return ops.where(F.col("op").isin(*_RESETS)).groupBy("g").agg(F.max("seq").alias("reset"))


def unhidden(rows: DataFrame, resets: DataFrame) -> DataFrame:
    """Statements with their ``seq`` but for those of graphs that were emptied later; those without ``seq`` came first.

    A graph with most of the rows is one key of the join; its side is split by adaptive execution, as the other
    side has one row per graph.
    """
    rows, resets = rows.alias("w"), resets.alias("r")
    kept = rows.join(resets, F.col("w.g").eqNullSafe(F.col("r.g")), "left").where(
        F.col("r.reset").isNull() | (F.col("w.seq") >= F.col("r.reset"))
    )
    return kept.select("w.*")


def graph_log_replay(
    ops: DataFrame, payload: DataFrame, initial: DataFrame | None = None
) -> DataFrame:
    """The quads after all operations. The last PUT or DELETE of a graph counts, and POSTs after it."""
    rows = _writes(ops, payload)
    if initial is not None:
        before = F.lit(None).cast("bigint").alias("seq")
        rows = rows.unionByName(initial.select(before, *QUAD_COLS))
    return statement_set(unhidden(rows, last_resets(ops)))


def graph_log_outcomes(
    ops: DataFrame, payload: DataFrame, block_width: int = DEFAULT_BLOCK
) -> DataFrame:
    """Per operation: ``success``, ``status`` and the number of statements in its graph afterwards.

    GET and DELETE fail with 404 on a named graph that is not there; the default graph always is.
    """
    is_write = F.col("op") != "GET"
    # What went before, and which stretch between two resets an operation belongs to.
    log = stage(
        running(
            ops, ["g"], ["seq"], block_of("seq", block_width),
            {
                "prior": ("max_before", F.when(is_write, F.struct("seq", "op"))),
                "epoch": ("max", F.when(F.col("op").isin(*_RESETS), F.col("seq"))),
            },
        ).select(
            "seq", "op", "g", F.coalesce("epoch", F.lit(-1)).cast("bigint").alias("epoch"),
            F.col("prior.op").alias("_prior"),
        ),
        "graph-log",
    )
    adds = log.where(F.col("op").isin(*_ADDS)).select("seq", "g", "epoch")
    first = (
        payload.select("seq", *TRIPLE_COLS)
        .join(adds, "seq")
        .groupBy("epoch", *QUAD_COLS)
        .agg(F.min("seq").alias("seq"))
    )
    grown = first.groupBy("seq").agg(F.count(F.lit(1)).alias("_new"))
    sized = running(
        log.join(grown, "seq", "left"), ["g", "epoch"], ["seq"], block_of("seq", block_width),
        {"size_after": ("sum", F.coalesce("_new", F.lit(0)).cast("bigint"))},
    )
    there = F.col("g").isNull() | F.coalesce(F.col("_prior") != "DELETE", F.lit(False))
    success = F.col("op").isin(*_ADDS) | there
    created = F.col("op").isin(*_ADDS) & ~there
    status = F.when(~success, 404).when(created, 201).when(F.col("op") == "GET", 200).otherwise(204)
    return sized.select(
        "seq", "op", "g", success.alias("success"), status.cast("int").alias("status"), "size_after"
    )
