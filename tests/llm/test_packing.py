"""Packing: exact ids, whole coverage, and no more sequences than needed on small instances."""

import random
import zlib

import numpy as np
import pytest

from quadrille.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[k] += items[i]
            go(i + 1, bins)
            bins[k] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def counts_of(items):
    return {x: items.count(x) for x in set(items)}


def test_reduction_keeps_the_optimum():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        h = packing.Histogram(counts_of(items), capacity)
        fixed = packing.reduce_instance(h)
        rest = [n for n in range(capacity + 1) for _ in range(int(h.left[n]))]
        assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


def test_every_piece_is_packed_once():
    rng = random.Random(4)
    for _ in range(100):
        capacity = rng.choice([10, 50, 100])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        packed = packing.pack(counts_of(items), capacity)
        assert all(sum(p) <= capacity and n > 0 for p, n in packed)
        assert sorted(x for p, n in packed for x in p * n) == sorted(items)


def test_large_histogram_is_near_the_lower_bound():
    sizes = np.minimum(2048, np.random.default_rng(1).lognormal(6.2, 1.2, 20000).astype(int) + 1)
    values, n = np.unique(sizes, return_counts=True)
    made = sum(n for _, n in packing.pack(dict(zip(values.tolist(), n.tolist())), 2048))
    assert made <= 1.002 * -(-int(sizes.sum()) // 2048) + 1


@pytest.mark.parametrize("text", [
    "", " a\t b ", "It's don't 'tis x's", "İSTANBUL ΣΑΣ ς é café,", "<|endoftext|> <|startoftext|>x", "a...b ,, x;:",
    "١٢ 3.14 ²", "naïve—test“q”", "\x85a b\x1cc", "ÀÉ.Ö,ß! µ ª", "é Å", "　x y", "😀 a😀b"])
def test_ids_are_the_tokenizers(text):
    words = packing.WordIds(PATH)
    assert np.frombuffer(words.of(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_documents(spark):
    texts = ["alpha beta", "", None, "x " * 5000, "alpha beta", "one two three. " * 700, "ß"] + ["w " * (i * 37 % 900) for i in range(60)]
    rows = [(i if i != 6 else None, t, "a", 1, 2) for i, t in enumerate(texts)] + [(4, "alpha beta", "a", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, row int, bucket int")
    got = packing.best_fit_packing(docs, PATH).toPandas()
    words = packing.WordIds(PATH)
    want = []
    for doc_id, text, *_ in rows:
        ids = words.of(text or "") + b"\0\0\0\0"
        want += [(-1 if doc_id is None else doc_id, k, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192]))
                 for k, at in enumerate(range(0, len(ids), 8192))]
    own = got.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(own.astype(int).itertuples(index=False, name=None)) == sorted(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s["offset"] == s["length"].cumsum() - s["length"]).all() and s["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= -(-int(got["length"].sum()) // 2048) + 1


def test_empty_table(spark):
    assert packing.best_fit_packing(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
