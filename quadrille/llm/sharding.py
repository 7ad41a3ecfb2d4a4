"""Sharding by histogram sort: exact counts below probe keys, refined until the splitters fit.

Rows are ordered by a key of three 64-bit hashes: of the text, so equal texts stand together, of ``doc_id``,
and of the place of the row in a written table, so that even repeated rows can be parted. Every round
counts the bytes and rows of the cells between probe keys over all partitions, with the least and the
largest key of each cell, and puts new probes into the cells that hold a wanted boundary. Only the few rows
of those cells are counted again. A boundary is fixed when its bytes are within the tolerance, or a
single row is left. Then the rows move once, to the range they belong to.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quadrille.session import stage

KEY = ["k1", "k2", "k3"]
#: Probes for each boundary and round, and the share of a shard that a boundary may be off.
PROBES, TOLERANCE = 32, 0.0005
#: Rows of one task of the final sort, about; a shard with more is sorted in several ranges.
ROWS_PER_RANGE = 1 << 22
_SHIFT, _MASK = 1 << 63, (1 << 64) - 1


def _number(k1: int, k2: int, k3: int) -> int:
    """The key as one number of 192 bits, in the same order."""
    return (k1 + _SHIFT) << 128 | (k2 + _SHIFT) << 64 | (k3 + _SHIFT)


def _parts(number: int) -> tuple[int, int, int]:
    return tuple((number >> s & _MASK) - _SHIFT for s in (128, 64, 0))


def cell_of(probes: list[int], k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> np.ndarray:
    """For each row, the number of probes that are not above its key."""
    first = np.array([_parts(p)[0] for p in probes], np.int64)
    cell = np.searchsorted(first, k1, side="left")
    for i in np.flatnonzero(cell != np.searchsorted(first, k1, side="right")):
        cell[i] = bisect_right(probes, _number(int(k1[i]), int(k2[i]), int(k3[i])))
    return cell


def _count(probes: list[int], open_cells: set[int]):
    """Bytes, rows and key range of each cell that is open, for the rows of each batch."""
    wanted = np.zeros(len(probes) + 1, bool)
    wanted[list(open_cells)] = True

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = cell_of(probes, *(batch[k].to_numpy() for k in KEY))
            batch = batch.assign(cell=cell)[wanted[cell]].sort_values(["cell", *KEY])
            groups = batch.groupby("cell", sort=False)
            out = groups.agg(size=("size", "sum"), n=("size", "count")).reset_index()
            for name, end in (("lo", groups.head(1)), ("hi", groups.tail(1))):
                for k in KEY:
                    out[name + k] = end[k].to_numpy()
            yield out

    return run


def _histogram(rows: DataFrame, probes: list[int], open_cells: set[int]) -> dict[int, tuple[int, int, int, int]]:
    """``cell -> bytes, rows, least key, largest key`` of the open cells that have rows."""
    schema = "cell int, size long, n long, " + ", ".join(f"{e}{k} long" for e in ("lo", "hi") for k in KEY)
    lo, hi = (F.struct(*(e + k for k in KEY)) for e in ("lo", "hi"))
    found = (
        rows.select(*KEY, "size").mapInPandas(_count(probes, open_cells), schema).groupBy("cell")
        .agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min(lo).alias("lo"), F.max(hi).alias("hi")).collect()
    )
    return {r["cell"]: (r["size"], r["n"], _number(*r["lo"]), _number(*r["hi"])) for r in found}


def splitters(rows: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[int]:
    """``parts - 1`` keys that cut the rows in parts of about equal ``size``; a row belongs above its key.

    ``rows`` has ``k1, k2, k3, size``. What the driver holds are ``PROBES`` numbers for each boundary.
    """
    whole = _histogram(rows, [], {0}).get(0)
    if whole is None:
        return [0] * (parts - 1)
    total, n, lo, hi = whole
    allowed = tolerance * total / parts
    found: dict[int, int] = {}
    # Of each open boundary: bytes below its range, then bytes, rows and key range of the range.
    ranges = {i: (0, total, n, lo, hi) for i in range(1, parts)}
    while ranges:
        probes: set[int] = set()
        for below, size, count, lo, hi in set(ranges.values()):
            wanted = [i for i, r in ranges.items() if r[3] == lo]
            k = max(PROBES, 4 * len(wanted))
            probes.update({lo, hi + 1}, (lo + (hi + 1 - lo) * j // k for j in range(1, k)))
        ordered = sorted(probes)
        spans = {r[3]: r for r in ranges.values()}
        open_cells = {c for r in spans.values() for c in range(bisect_right(ordered, r[3]), bisect_right(ordered, r[4]) + 1)}
        cells = _histogram(rows, ordered, open_cells)
        for i, (below, size, count, lo, hi) in list(ranges.items()):
            target = total * i / parts
            at = below
            for c in range(bisect_right(ordered, lo), bisect_right(ordered, hi) + 1):
                if c not in cells:
                    continue
                size_c, n_c, lo_c, hi_c = cells[c]
                if at + size_c >= target or hi_c == hi:
                    if target - at <= allowed:
                        found[i] = lo_c
                    elif at + size_c - target <= allowed:
                        found[i] = hi_c + 1
                    elif n_c == 1 or lo_c == hi_c:
                        found[i] = lo_c if target - at <= at + size_c - target else hi_c + 1
                    if i in found:
                        del ranges[i]
                    else:
                        ranges[i] = (at, size_c, n_c, lo_c, hi_c)
                    break
                at += size_c
    return [found[i] for i in range(1, parts)]


def histogram_sort(rows: DataFrame, shards: int, key: list, size, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with ``size, shard, slot``: shards of about equal size, in order of the hashes of ``key``.

    ``key`` are column expressions, the first for what should stay together; ``size`` is an expression.
    ``slot`` counts the rows of a shard from 0 without gaps. Every shard is off by the tolerance or one row
    at most; with fewer rows than shards some stay empty.
    """
    own = F.struct(*rows.columns).alias("row")
    named = rows.select(own, size.cast("long").alias("size"),
                        *(F.xxhash64(k).alias(f"k{i}") for i, k in enumerate(key, 1)), F.xxhash64(
                            F.monotonically_increasing_id()).alias("k3"))
    written = stage(named, "shard-rows")
    n = written.count()
    per = max(1, -(-n // (shards * ROWS_PER_RANGE)))
    cuts = splitters(written, shards * per, tolerance)

    @pandas_udf("int")
    def range_of(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        return pd.Series(cell_of(cuts, k1.to_numpy(), k2.to_numpy(), k3.to_numpy()))

    placed = written.withColumn("range", range_of(*KEY))
    before = (
        placed.groupBy("range").agg(F.count("*").alias("n")).withColumn("shard", F.floor(F.col("range") / per).cast("int"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).drop("n")
    )
    order = Window.partitionBy("range").orderBy(*KEY)
    ranked = placed.withColumn("rank", F.row_number().over(order) - 1)
    # One row per range: at most `shards` times the rows over ROWS_PER_RANGE.
    return ranked.join(F.broadcast(before), "range").select(
        "row.*", "size", "shard", (F.col("before") + F.col("rank")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = TOLERANCE) -> DataFrame:
    """All columns of ``docs`` with ``size``, ``shard`` and ``slot``; texts that are equal stand together.

    The size is the bytes of the text in UTF-8 plus 16. NULL texts count as empty ones of their own group.
    A group of equal texts is cut only where a boundary of the shards needs it. Repeated rows and rows
    without ``doc_id`` are placed like any other. An empty table gives an empty result. Columns of ``docs``
    named ``size``, ``shard`` or ``slot`` are refused.
    """
    taken = {"size", "shard", "slot"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are results")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    return histogram_sort(docs, shards, [F.col("text"), F.col("doc_id")], size, tolerance)
