"""Merkle manifest of a dataset: a tree of hashes over rows, built and read back by nested structs.

A leaf is the hash of a row. Leaves of a group (a language) are ranked by id, and the digits of a rank in the base of
the fan-out name its place in the tree. Within blocks of ``fanout ** DIGITS`` ranks the digits are grouped away one
after the other, lowest first: each grouping makes an array of at most ``fanout`` child structs, whose hash is the
node and which becomes part of the struct one level up. What is left is one row per block with its whole tree inside.
The roots of blocks are ranked rows again and go through the same steps until each group has one root, and the roots of
the groups likewise.

On the way back every array of children is transformed to steps (the hashes left and right of a child) and exploded,
so each leaf comes out with its proof. No join makes a proof: the proof of a block's root gets to the block by
grouping both by the block's number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.session import stage

#: Levels of a block: its row holds ``fanout ** DIGITS`` leaves at most (512, about 80 kB).
FANOUT, DIGITS = 8, 3
#: Levels that a tree can have: more rows than a table of Spark can number.
MOST_LEVELS = 21

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value so that no two lists of values are written alike: ``-`` for NULL, else bytes, colon, text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: dict[str, Column]) -> Column:
    return _hash(*(field(v) for v in values.values()))


def _ranked(nodes: DataFrame, order: list[str], fanout: int) -> DataFrame:
    """Adds ``rank`` within ``tree``, from 0, and ``depth``, the levels above the leaves of the tree.

    The rows are dealt by ranges of ``tree`` and ``order`` and written; a row's rank is its place in its part and what
    the parts before it have of its tree. The parts and trees of each are the only rows of the window.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    placed = stage(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "*", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row")), "merkle-ranks")
    sizes = placed.groupBy("part", "tree").agg(F.count("*").alias("n"), F.min("row").alias("begin"))
    whole = Window.partitionBy("tree")
    depth = sum((F.when(F.col("total") > fanout**k, 1).otherwise(0) for k in range(MOST_LEVELS)), F.lit(0))
    sizes = sizes.select(
        F.col("part").alias("in_part"), F.col("tree").alias("in_tree"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("begin")).alias("shift"),
        F.sum("n").over(whole).alias("total")).withColumn("depth", depth)
    return placed.join(sizes, (F.col("part") == F.col("in_part")) & F.col("tree").eqNullSafe(F.col("in_tree"))).select(
        *nodes.columns, (F.col("row") + F.col("shift")).alias("rank"), "depth")


def _rolled(nodes: DataFrame, fanout: int) -> DataFrame:
    """``tree, depth, block, hash, kids``: a row per block with the structs of its nodes, nested.

    ``nodes`` has ``tree, depth, rank, hash, load``. Blocks of a tree that ends below their top pass its root on.
    """
    digits = [f"digit{k}" for k in range(DIGITS)]
    place = [F.pmod(F.floor(F.col("rank") / fanout**k), F.lit(fanout)).cast("int").alias(d) for k, d in enumerate(digits)]
    rows = nodes.select("tree", "depth", F.floor(F.col("rank") / fanout**DIGITS).alias("block"), *place, "hash", "load")
    # Dealt once: every grouping below has the columns of this exchange among its own.
    rows = rows.repartition("tree", "depth", "block")
    for k, digit in enumerate(digits, 1):
        inner = ["load"] if k == 1 else ["kids"]
        kids = F.sort_array(F.collect_list(F.struct(digit, "hash", *inner)))
        rows = rows.groupBy("tree", "depth", "block", *digits[k:]).agg(kids.alias("kids"))
        node = F.sha2(F.array_join("kids.hash", "").cast("binary"), 256)
        rows = rows.withColumn("hash", F.when(F.col("depth") >= k, node).otherwise(F.col("kids")[0]["hash"]))
    return rows


def _steps(kids: str) -> Column:
    """Each child with the hashes left and right of it."""
    hashes = F.col(f"{kids}.hash")

    def step(child: Column, i: Column) -> Column:
        left = F.array_join(F.slice(hashes, F.lit(1), i), "")
        right = F.array_join(F.slice(hashes, i + 2, F.size(hashes)), "")
        return F.struct(child.alias("child"), F.struct(left.alias("left"), right.alias("right")).alias("step"))

    return F.transform(kids, step)


def _unrolled(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """``tree, hash, load, path, top`` of every node that was rolled up.

    ``above`` has ``tree, rank, path, top`` of the blocks' roots: the steps from there to the root of all.
    """
    both = blocks.select("tree", "block", "depth", "kids").unionByName(
        above.select("tree", F.col("rank").alias("block"), "path", "top"), allowMissingColumns=True)
    rows = both.groupBy("tree", "block").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("depth", "kids", "path", "top")))
    for level in range(DIGITS, 0, -1):
        path = F.when(F.col("depth") >= level, F.concat(F.array("one.step"), "path")).otherwise(F.col("path"))
        inner = ["load"] if level == 1 else ["kids"]
        rows = rows.withColumn("one", F.explode(_steps("kids"))).select(
            "tree", "depth", "one.child.hash", *(f"one.child.{c}" for c in inner), path.alias("path"), "top")
    return rows


def _roll_up(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The written blocks of all stages, the lowest first; the last has one row per tree."""
    stages = []
    while True:
        blocks = stage(_rolled(nodes, fanout), "merkle-blocks")
        stages.append(blocks)
        if not (blocks.agg(F.max("block")).first()[0] or 0):
            return stages
        nodes = blocks.select("tree", F.greatest(F.col("depth") - DIGITS, F.lit(0)).alias("depth"), F.col("block").alias("rank"),
                              "hash", F.struct("block").alias("load"))


def _roll_down(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in reversed(stages[1:]):
        above = _unrolled(blocks, above).select("tree", F.col("load.block").alias("rank"), "path", "top")
    return _unrolled(stages[0], above)


def merkle_manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None,
                    fanout: int = FANOUT) -> DataFrame:
    """Leaves, proofs and roots of a dataset: ``doc_id, leaf, evidence, path, subroot, root``.

    Takes ``doc_id, source, lang, n_chars, text`` of ``docs``. ``leaf`` is the hash of the row; ``path`` the steps to the
    root, each with the hashes ``left`` and ``right`` of the node on the way; ``subroot`` the root of the rows of one
    ``lang``, by ``doc_id``, and ``root`` that of all subroots, by ``lang``, each level taking ``fanout`` nodes in a row
    while there is more than one. ``evidence`` is what to check against the root: the leaf, or that of the row with the
    columns ``tampered`` put in place ``where`` this is true.

    A NULL in any column is hashed as such; rows without ``lang`` are the first group, rows without ``doc_id`` the first of
    theirs. Repeated rows are leaves of their own; rows of one ``doc_id`` are ordered by leaf. A text is hashed whole,
    whatever its length, and never moves: only hashes do. Other columns are ignored, whatever their names. An empty
    table gives an empty result.
    """
    values = {c: F.col(c) for c in COLUMNS}
    evidence = F.lit(None).cast("string")
    if tampered:
        changed = leaf_hash(values | tampered)
        evidence = changed if where is None else F.when(where, changed)
    leaves = stage(docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("id"), leaf_hash(values).alias("hash"),
                               evidence.alias("evidence")), "merkle-leaves")
    nodes = _ranked(leaves, ["id", "hash", "evidence"], fanout).select(
        "tree", "depth", "rank", "hash", F.struct("id", "evidence").alias("load"))
    stages = _roll_up(nodes, fanout)

    subroots = stages[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("group"), "hash")
    nodes = _ranked(subroots, ["group"], fanout).select("tree", "depth", "rank", "hash", F.struct("group").alias("load"))
    groups = _roll_up(nodes, fanout)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    above = groups[-1].select("tree", F.lit(0).cast("long").alias("rank"), no_path.alias("path"), F.col("hash").alias("top"))
    above = _roll_down(groups, above).select(
        F.col("load.group").alias("tree"), F.lit(0).cast("long").alias("rank"), "path",
        F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"))
    return _roll_down(stages, above).select(
        F.col("load.id").cast("long").alias("doc_id"), F.col("hash").alias("leaf"),
        F.coalesce("load.evidence", "hash").alias("evidence"), "path", "top.subroot", "top.root")


def folded(evidence: str = "evidence", path: str = "path") -> Column:
    """The root that a leaf and the hashes of its proof lead to."""
    return F.aggregate(path, F.col(evidence), lambda node, step: _hash(step["left"], node, step["right"]))


def proof_digest(path: str = "path") -> Column:
    """Hash of all hashes of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def digests(manifest: DataFrame) -> DataFrame:
    """A manifest with a digest of each proof, and whether the evidence leads to the root."""
    return manifest.withColumn("folded_root", folded()).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest_digests(docs: DataFrame) -> DataFrame:
    """The registered form: rows whose ``crc32`` of the id can be divided by 3 come with A-Z of the text lower-cased."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return digests(merkle_manifest(docs, {"text": lower_ascii(F.col("text"))}, third))


def _sql_field(column: str) -> str:
    return f"coalesce(strlen(cast({column} as varchar)) || ':' || {column}, '-')"


def _sql_tree(name: str, levels: int) -> str:
    """Tables ``{name}1 … `` of the levels above ``{name}0 (tree, i, h, n)``, and ``{name}s0 …`` with left and right."""
    out = []
    for k in range(levels):
        window = "partition by tree, i // 8 order by i rows between"
        out.append(f"{name}s{k} as (select tree, i, n, h, "
                   f"coalesce(string_agg(h, '') over ({window} unbounded preceding and 1 preceding), '') as l, "
                   f"coalesce(string_agg(h, '') over ({window} 1 following and unbounded following), '') as r from {name}{k})")
        out.append(f"{name}{k + 1} as (select tree, i // 8 as i, case when n > 1 then sha256(string_agg(h, '' order by i)) "
                   f"else min(h) end as h, (n + 7) // 8 as n from {name}{k} group by tree, i // 8, n)")
    return ",\n".join(out)


def _sql_walk(name: str, source: str, levels: int, tree: str) -> str:
    """Tables ``{name}w0 …``: a row of ``source (tree columns, i, folded, proof)`` on its way up."""
    out = [f"{name}w0 as (select * from {source})"]
    for k in range(levels):
        out.append(
            f"{name}w{k + 1} as (select w.* replace (w.i // 8 as i, case when s.n > 1 then sha256(s.l || w.folded || s.r) "
            f"else w.folded end as folded, w.proof || s.l || s.r as proof) "
            f"from {name}w{k} w join {name}s{k} s on s.tree is not distinct from {tree} and s.i = w.i)")
    return ",\n".join(out)


def manifest_sql(levels: int = 9, group_levels: int = 3) -> str:
    """The query of ``manifest_digests`` for up to ``8 ** levels`` documents of a language."""
    row = " || ".join(_sql_field(c) for c in COLUMNS)
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = " || ".join(_sql_field(lowered if c == "text" else c) for c in COLUMNS)
    bits = "flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [cast(ascii(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))"
    step = "case when xor(a, x) & 1 = 1 then xor(xor(a, x) >> 1, 3988292384) else xor(a, x) >> 1 end"
    crc = f"xor(list_reduce(list_concat([cast(4294967295 as bigint)], {bits}), lambda a, x: {step}), 4294967295)"
    return f"""
with leaves as (
  select doc_id, lang, sha256({row}) as leaf, case when {crc} % 3 = 0 then sha256({changed}) else sha256({row}) end as evidence
  from documents),
d as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n from leaves),
d0 as (select lang as tree, i, leaf as h, n from d),
{_sql_tree("d", levels)},
g as (select tree as lang, h as subroot from d{levels}),
g0 as (select 0 as tree, row_number() over (order by lang nulls first) - 1 as i, subroot as h, count(*) over () as n from g),
{_sql_tree("g", group_levels)},
start as (select doc_id, leaf, lang, i, evidence as folded, '' as proof from d),
{_sql_walk("d", "start", levels, "w.lang")},
up as (select w.* replace (p.i as i), g.subroot from dw{levels} w join g on g.lang is not distinct from w.lang
  join (select lang, row_number() over (order by lang nulls first) - 1 as i from g) p on p.lang is not distinct from w.lang),
{_sql_walk("g", "up", group_levels, "0")}
select doc_id, leaf, subroot, (select h from g{group_levels}) as root, sha256(proof) as proof_sha256, folded as folded_root,
  folded = (select h from g{group_levels}) as verified
from gw{group_levels}"""
