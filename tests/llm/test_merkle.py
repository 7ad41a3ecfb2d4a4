"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quadrille.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree int, rank string, hash string, kids int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """Root, and for each leaf its steps as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // fanout * fanout
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + fanout])))
            at[k] = i // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: climb([leaf(r) for r in order[g]], fanout) for g in langs}
    root, upper = climb([trees[g][0] for g in langs], fanout)
    out = []
    for g, above in zip(langs, upper):
        for r, path in zip(order[g], trees[g][1]):
            path = path + above
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                node = h(left, node, right)
            proof = h(*(a + b for a, b in path))
            out.append((r[0], leaf(r), trees[g][0], root, proof, node, node == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "r", "h", 2) for r in rows], SCHEMA)


def many(n, lang):
    return [(i * 3 + 1, f"s{i % 3}", lang, i, f"Text {i} É") for i in range(n)]


ODD = [(1, None, None, None, None), (1, None, None, None, None), (None, "s", "en", 3, "Abc"), (None, "s", "en", 3, "Abc"),
       (2, "", "", 0, ""), (3, "S", "ß", 1, "ÀB"), (4, "x", "z", 5, "no capitals here"), (6, "x", "EN", 5, "CAPITALS"), (6, "x", "EN", 6, "two of one id"),
       (-5, "x", None, 5, "Negative"), (9, "long", "long", 10**6, "Long wörds " * 100_000)]


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("rows", [
    ODD, ODD + many(9, "en"), many(1, "a"), many(8, "a") + many(64, "b") + many(65, "c"),
    many(513, "a") + many(600, None) + many(511, "b") + many(1, "c"),
], ids=["odd", "mixed", "one", "full runs", "over a block"])
def test_as_a_plain_tree(spark, rows):
    assert result(merkle.manifest_digests(frame(spark, rows))) == sorted(plain(rows), key=str)


def test_many_stages_and_groups(spark, monkeypatch):
    """Blocks of one level each: several stages of blocks for the rows and for the groups."""
    monkeypatch.setattr(merkle, "DIGITS", 1)
    rows = many(130, "a") + [(i, "s", f"lang{i}", 1, "T") for i in range(1000, 1040)]
    assert result(merkle.manifest_digests(frame(spark, rows))) == sorted(plain(rows), key=str)


def test_other_fanout_and_untampered(spark):
    rows = many(77, "a") + many(20, "b")
    got = merkle.merkle_manifest(frame(spark, rows), fanout=3)
    want = {(p[0], p[1], p[2], p[3], p[4]) for p in plain(rows, 3)}
    full = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("p"), "evidence", merkle.folded().alias("f"))
    found = full.collect()
    assert {tuple(r[:5]) for r in found} == want
    assert all(r["evidence"] == r["leaf"] and r["f"] == r["root"] for r in found)


def test_any_change_is_seen(spark):
    rows = many(40, "a")
    for column, value in (("n_chars", F.lit(7777)), ("source", F.lit(None).cast("string")), ("doc_id", F.col("doc_id") + 1)):
        got = merkle.digests(merkle.merkle_manifest(frame(spark, rows), {column: value}))
        assert not any(r["verified"] for r in got.collect())


def test_fields_are_told_apart(spark):
    a = frame(spark, [(1, "ab", "c", 1, "x")])
    b = frame(spark, [(1, "a", "bc", 1, "x")])
    first = [merkle.merkle_manifest(d).first()["leaf"] for d in (a, b)]
    assert first[0] != first[1]


def test_empty_table(spark):
    assert merkle.manifest_digests(frame(spark, [])).collect() == []
