"""b-bit MinHash near-dedup against all pairs, and its estimate against exact similarities."""

import numpy as np
import pytest

from quadrille.llm import bbit_minhash

from .test_joins import brute, frame, varied


def plain(rows, width=5, percent=85):
    return sorted(((i, n, c, i == c) for i, n, c, _ in brute(rows, width, percent)), key=str)


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=str)


def near_family(n=120, words=90):
    """Copies with one word changed each: of any two, the sets share well over the threshold or not at all."""
    base = [f"q{i}" for i in range(words)]
    return [(5000 + i, " ".join(base[:i % words] + [f"edit{i}"] + base[i % words + 1 :])) for i in range(n)]


def test_as_by_all_pairs(spark):
    rows = varied() + near_family()
    assert result(bbit_minhash.bbit_near_duplicates(frame(spark, rows))) == plain(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(bbit_minhash, "BLOCK_ELEMENTS", 400)
    monkeypatch.setattr(bbit_minhash, "BLOCK_ROWS", 7)
    rows = varied() + near_family(60)
    got = bbit_minhash.bbit_near_duplicates(frame(spark, rows), 5, 80, permutations=128, bits=4, rows=4)
    assert result(got) == plain(rows, 5, 80)


def test_empty_table_and_tables_without_words(spark):
    assert bbit_minhash.bbit_near_duplicates(frame(spark, [])).collect() == []
    rows = [(1, None), (2, ""), (3, " \n"), (None, None), (3, " \n")]
    assert result(bbit_minhash.bbit_near_duplicates(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_estimates_follow_jaccard(bits):
    minhash = bbit_minhash.BBitMinHash(2048, bits)
    rng = np.random.default_rng(bits)
    for share in (0.0, 0.3, 0.85, 1.0):
        x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
        both = int(3000 * share)
        a, b = np.sort(x[: both + (3000 - both) // 2]), np.sort(np.concatenate((x[:both], x[both + (3000 - both) // 2 :])))
        minima = minhash.minima([a, b])
        packed = minhash.pack(minima)
        equal = bbit_minhash.equal_fields(packed[0], packed[1:], bits)
        low = minima & ((1 << bits) - 1)
        assert equal[0] == (low[0] == low[1]).sum()
        assert float(bbit_minhash.similarity(equal, 2048, bits)[0]) == pytest.approx(share, abs=0.12)


def test_minima_are_those_of_a_plain_loop():
    minhash = bbit_minhash.BBitMinHash(64, 1)
    sets = [np.array([5, 99, 1 << 60], np.uint64), np.array([7], np.uint64)]
    want = [[min((int(x) * int(a) + int(b)) % 2**64 for x in s) >> 32 for a, b in zip(minhash.a, minhash.b)] for s in sets]
    assert minhash.minima(sets).tolist() == want


def test_the_estimate_loses_few():
    k = bbit_minhash.least_equal(85)
    rng = np.random.default_rng(1)
    equal = rng.binomial(160, 0.25 + 0.75 * 0.85, 1_000_000)
    assert equal.min() >= k and bbit_minhash.similarity(np.array(k)) > 0.55
    assert bbit_minhash.least_equal(100) == 160


def test_a_family_of_copies_is_walked_once():
    asked = []

    def linked(i, rest):
        asked.append(len(rest))
        return np.ones(len(rest), bool)

    same = np.zeros((5000, 3), np.int64)
    assert (bbit_minhash.forest(same, linked) == 0).all() and sum(asked) == 4999
    chain = bbit_minhash.forest(same[:50], lambda i, rest: np.abs(rest - i) == 1)
    assert (chain == 0).all()
    assert bbit_minhash.forest(same[:0], linked).tolist() == []
    asked.clear()
    apart = np.arange(6000).reshape(2000, 3)
    apart[1::2, 1] = apart[::2, 1]
    assert (bbit_minhash.forest(apart, linked) == np.arange(2000) // 2 * 2).all() and sum(asked) == 1000
