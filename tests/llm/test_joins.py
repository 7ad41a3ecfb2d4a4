"""The n-gram join and the MinHash join against all pairs."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrille import session
from quadrille.llm import fingerprints, ngram_join

SCHEMA = "doc_id long, text string, u string, v long, key int, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "u", 1, 2, 3) for i, t in rows], SCHEMA)


def brute(rows, width, percent):
    """doc_id, set size, smallest doc_id reachable, links; rows in order."""
    def shingles(text):
        w = [x for x in (text or "").encode().lower().split() if x]
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = [shingles(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), (i if not sets[k] else min(ids, default=None)), links[k]))
    return sorted(out, key=str)


def varied():
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(words[k * 40 : k * 40 + 60]) for k in range(6)]
    rows = [(i, t) for i, t in enumerate(base, 100)]
    n = 200
    for k, t in enumerate(base):
        w = t.split()
        for edit in range(8):
            v = list(w)
            for e in range(edit):
                v[(e * 17 + k) % len(v)] = f"x{k}{edit}{e}"
            rows.append((n, " ".join(v)))
            n += 1
    # A chain whose ends do not link, a common line, short texts, ties, repeated rows, no text.
    chain = [f"c{i}" for i in range(90)]
    rows += [(n + i, " ".join(chain[i * 4 : i * 4 + 50])) for i in range(10)]
    rows += [(n + 20 + i, "shared line of the site now " + " ".join(f"y{i}z{j}" for j in range(4))) for i in range(30)]
    rows += [(900, "one"), (901, "ONE"), (902, "one two"), (903, "one\ttwo\n"), (904, "one two three four"),
             (905, ""), (906, None), (907, " \n\t"), (907, " \n\t"), (2, base[0]), (2, base[0]), (None, base[1]), (None, "lonely one here"),
             (908, "É é ünï code wörds"), (909, "é é ünï code wörds")]
    rows.append((910, " ".join(words * 60)))
    return rows


def result(df):
    return sorted(((r[0], r[1], r[2], r[3]) for r in df.collect()), key=str)


def test_ngram_join_is_that_of_all_pairs(spark):
    rows = varied()
    got = ngram_join.ngram_jaccard_join(frame(spark, rows))
    assert result(got) == brute(rows, 4, 85)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = varied()
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", 300)
    assert result(ngram_join.ngram_jaccard_join(frame(spark, rows), 5, 80)) == brute(rows, 5, 80)


def test_empty_table(spark):
    got = ngram_join.ngram_jaccard_join(frame(spark, []))
    assert got.collect() == [] and got.columns[:3] == ["doc_id", "n_shingles", "component_id"]


def test_minhash_join_is_that_of_all_pairs(spark):
    rows = [r for r in varied() if r[0] is not None]
    assert result(fingerprints.near_duplicates(frame(spark, rows))) == brute(rows, 5, 80)


def test_one_row_of_each_group_stays(spark):
    rows = varied()
    kept = ngram_join.keep_one_per_group(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "u", "v", "key", "row"]
    got = [r["doc_id"] for r in kept.collect()]
    want = brute(rows, 4, 85)
    groups = {c for i, n, c, _ in want if n}
    blank = [i for i, n, _, _ in want if not n]
    assert sorted(got, key=str) == sorted([g for g in groups if g is not None] + [None] + blank, key=str)


@pytest.mark.parametrize("text, n", [("a b c d", 1), ("a b c d e", 2), ("a a a a a", 1), ("a", 1), ("", 0)])
def test_set_sizes(spark, text, n):
    assert ngram_join.ngram_jaccard_join(frame(spark, [(1, text)])).first()["n_shingles"] == n


def test_ngrams_are_made_and_moved_once(spark, monkeypatch):
    plans, stage = [], ngram_join.stage

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(ngram_join, "stage", seen)
    rows = varied()
    assert result(ngram_join.ngram_jaccard_join(frame(spark, rows))) == brute(rows, 4, 85)
    first = next(plan for name, plan in plans if name == "grams")
    assert first.count("MapInPandas") == 1 and first.count("Exchange hashpartitioning") == 1


def test_texts_stay_where_they_are(spark, monkeypatch):
    plans, stage = [], ngram_join.stage

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(ngram_join, "stage", seen)
    rows = varied()
    assert result(ngram_join.ngram_jaccard_join(frame(spark, rows))) == brute(rows, 4, 85)
    moved = [x for x in next(plan for name, plan in plans if name == "sets").splitlines() if "hashpartitioning" in x]
    assert moved and all("hashpartitioning(key#" in x for x in moved)


def test_filter_lets_all_wanted_and_few_others_through(spark):
    chosen = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), (F.col("id") * 7).alias("tid"))
    others = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") * 7 + 1).alias("tid"))
    wanted = SimpleNamespace(value=ngram_join._filter(chosen))
    assert wanted.value.nbytes == 1 << ngram_join.FILTER_BITS >> 3
    run = ngram_join._full_sets(4, wanted)

    def through(df):
        batch = df.select(ngram_join._place().alias("place"), F.lit(b"a b c d e").alias("text")).toPandas()
        return sum(len(x) for x in run(iter([batch])))

    assert through(chosen) == 3000
    assert through(others) < 30


def test_batches_for_python_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64MB")
        ngram_join.ngram_jaccard_join(frame(spark, [(1, "a b c d e"), (2, "a b c d e")]))
        assert session._bytes(spark.conf.get(key)) <= session.BATCH_BYTES
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("step", ["describe", "prefixes", "sets"])
def test_memory_of_a_worker(step):
    texts = [" ".join(f"w{i * 700 + j}" for j in range(700)).encode() for i in range(800)]
    batch = pd.DataFrame({"doc_id": range(800), "tid": range(800), "text": texts})
    run = {"describe": ngram_join._describe(4),
           "prefixes": ngram_join._prefixes(4, 85, SimpleNamespace(value=np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8))),
           "sets": ngram_join._full_sets(4)}[step]
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        # The cells of the sketch take 16 MB.
        assert tracemalloc.get_traced_memory()[1] < (32 << 20 if step == "describe" else 20 << 20)
    finally:
        tracemalloc.stop()
