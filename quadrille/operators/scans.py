"""Running aggregates over long ordered logs, split so that no group has to fit one task.

A plain window ``partitionBy(key).orderBy(pos)`` puts a whole key on one task, and one key may hold a
third of the rows. Here each key is cut in blocks of ``pos``; the blocks are summed up first (combined
before the shuffle), the few block totals are accumulated per key, and each block then only needs
its own rows and the total of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a log with unique positions that may fall in one block.
DEFAULT_BLOCK = 1_000_000

_AGGREGATES = {"sum": F.sum, "max": F.max}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    aggs: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add a column per entry of ``aggs`` with the running ``sum`` or ``max`` within ``keys``.

    ``sum_before`` and ``max_before`` leave the current row out. ``block`` must rise with ``order``
    within a key. "Last value so far" is the running ``max`` of a struct that starts with the
    position. Keys may be NULL; with nothing to aggregate yet the result is NULL.
    """
    current = {name: 0 if not kind.endswith("_before") else -1 for name, (kind, _) in aggs.items()}
    aggs = {name: (kind.removesuffix("_before"), value) for name, (kind, value) in aggs.items()}
    base = df.select(
        "*",
        F.struct(*keys).alias("_key"),
        block.alias("_blk"),
        *[value.alias(f"_in_{name}") for name, (_, value) in aggs.items()],
    )
    totals = base.groupBy("_key", "_blk").agg(
        *[_AGGREGATES[kind](f"_in_{name}").alias(f"_tot_{name}") for name, (kind, _) in aggs.items()]
    )
    earlier_blocks = (
        Window.partitionBy("_key").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select(
        "_key",
        "_blk",
        *[
            _AGGREGATES[kind](f"_tot_{name}").over(earlier_blocks).alias(f"_bef_{name}")
            for name, (kind, _) in aggs.items()
        ],
    )
    in_block = Window.partitionBy("_key", "_blk").orderBy(*order)
    local = base.select(
        "*",
        *[
            _AGGREGATES[kind](f"_in_{name}")
            .over(in_block.rowsBetween(Window.unboundedPreceding, current[name]))
            .alias(f"_loc_{name}")
            for name, (kind, _) in aggs.items()
        ],
    )
    joined = local.join(before, ["_key", "_blk"], "left")
    out = []
    for name, (kind, _) in aggs.items():
        here, past = F.col(f"_loc_{name}"), F.col(f"_bef_{name}")
        if kind == "sum":
            total = F.when(
                here.isNotNull() | past.isNotNull(),
                F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0)),
            )
        else:
            total = F.greatest(here, past)  # skips NULL
        out.append(total.alias(name))
    return joined.select(*df.columns, *out)


def block_of(pos: str | Column, width: int = DEFAULT_BLOCK) -> Column:
    """Blocks of ``width`` consecutive positions."""
    col = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(col / F.lit(width))


def count_windows(
    df: DataFrame, key: Sequence[str], pos: str, n: int, step: int | None = None,
    block_width: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Windows of ``n`` consecutive elements per key, a new one every ``step`` elements.

    Adds ``window`` (0, 1, …) and ``window_pos`` (place inside the window); the last window may be
    short. With ``step < n`` elements belong to several windows, with ``step > n`` some to none.
    """
    step = step or n
    numbered = running(
        df, key, [pos], block_of(pos, block_width), {"_rn": ("sum", F.lit(1).cast("bigint"))}
    ).withColumn("_rn", F.col("_rn") - 1)
    if step == n:
        return numbered.select(
            *df.columns,
            F.floor(F.col("_rn") / n).alias("window"),
            (F.col("_rn") % n).alias("window_pos"),
        )
    # Windows k with k*step <= rn < k*step + n. A later window exists only while the previous one has
    # not yet reached the end, so windows that hold nothing new are left out.
    size = group_sizes(df, key)
    first = F.greatest(F.lit(0), F.ceil((F.col("_rn") - n + 1) / step)).cast("bigint")
    last = F.floor(F.col("_rn") / step).cast("bigint")
    last_window = F.greatest(F.lit(0), F.ceil((F.col("_size") - n) / step)).cast("bigint")
    return (
        numbered.withColumn("_key", F.struct(*key))
        .join(size, "_key")
        .withColumn("_hi", F.least(last, last_window))
        .where(F.col("_hi") >= first)
        .select(*df.columns, "_rn", F.explode(F.sequence(first, F.col("_hi"))).alias("window"))
        .select(*df.columns, "window", (F.col("_rn") - F.col("window") * step).alias("window_pos"))
    )


def group_sizes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of elements per key, as ``(_key, _size)``."""
    return df.groupBy(F.struct(*key).alias("_key")).agg(F.count(F.lit(1)).alias("_size"))
