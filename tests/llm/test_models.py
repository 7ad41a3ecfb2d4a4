"""Toxicity, language and URL models: held-out accuracy, plain versions, odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from quadrille.llm import language, pieces, toxicity, url_filter
from quadrille.llm.queries import URL_RULES, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, row int, features string, score string"


def crc(i):
    return zlib.crc32(str(i).encode())


def toxic_world(n=900):
    rng = random.Random(2)
    clean = ["river", "table", "window", "green", "seven", "talking", "market", "winter", "paper", "garden"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(3, 60))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(1 + len(words) // 15):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grumbold", "snarkwit" + rng.choice("abcdef"), "You grumbold!"]))
        docs.append((i, " ".join(words), "en", 1, "f", "s"))
        if i % 3:
            labels.append((i, 0, int(bad)))
    return docs, labels, {i: int(b) for i, _, b in labels}


def test_toxicity_of_held_out_rows(spark):
    docs, labels, truth = toxic_world()
    odd = [(5000, None, None, 1, "", ""), (5001, "", "en", 1, "", ""), (None, "grumbold you grumbold", "en", 1, "", ""),
           (5002, "river " * 30000, "en", 1, "", ""), docs[7], docs[7]]
    frame = spark.createDataFrame(docs + odd, DOCS)
    marks = spark.createDataFrame(labels + [(None, 0, 1), (labels[0][0], 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(frame, marks).collect()
    assert len(got) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and crc(r["doc_id"]) % 3 == 1) for r in got)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([a == b for a, b in held]) > 0.95
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["score"] == by_id[5001]["score"] and by_id[5000]["predicted"] == 0
    assert len({r["score"] for r in got if r["doc_id"] == 7}) == 1
    kept = toxicity.keep_civil(frame, marks)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if not r["predicted"])


@pytest.mark.parametrize("toxic_folds, apart", [((0, 1, 2, 3, 4), True), ((0, 1, 2, 3), False)])
def test_calibrated_on_other_rows_than_the_trees(spark, monkeypatch, toxic_folds, apart):
    docs, labels, _ = toxic_world()
    frame, marks = (spark.createDataFrame(x, c) for x, c in ((docs, DOCS), (labels, "doc_id long, quality int, toxic int")))
    fold = {r["doc_id"]: r["fold"] for r in marks.select("doc_id", toxicity._fold(5).alias("fold")).collect()}
    marks = spark.createDataFrame([(i, q, t if fold[i] in toxic_folds else 0) for i, q, t in labels], marks.schema)
    seen = {}
    for kind in (toxicity.GBTClassifier, toxicity.IsotonicRegression):
        def fit(self, rows, fit=kind.fit, name=kind.__name__):
            seen[name] = {r["doc_id"]: r["label"] for r in rows.select("*").collect()}
            return fit(self, rows)
        monkeypatch.setattr(kind, "fit", fit)
    toxicity.train(frame, marks)
    grown, calibrated = seen["GBTClassifier"], seen["IsotonicRegression"]
    assert (not grown.keys() & calibrated.keys()) == apart
    assert all(set(x.values()) == {0.0, 1.0} for x in (grown, calibrated))
    assert len(grown.keys() | calibrated.keys()) == sum(crc(i) % 3 != 1 and fold[i] >= 3 for i, _, _ in labels)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels, _ = toxic_world(300)
    frame = spark.createDataFrame(docs, DOCS)
    turned = [(i, q, 1 - t if crc(i) % 3 == 1 else t) for i, q, t in labels]
    scores = [sorted(toxicity.toxicity(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
              for x in (labels, turned)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 1, 1), (2, 1, 1)], None)])
def test_toxicity_without_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b", "en", 1, "", ""), (2, "c", "en", 1, "", "")], DOCS)
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 2 and (score is None or all(r["score"] == score for r in got))
    empty = docs.where("false")
    assert toxicity.toxicity(empty, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []


def test_hidden_words_and_persons():
    codes = toxicity.WordCodes({"idiot": 5.0, "loweis*": 4.0})
    f = dict(zip(toxicity.FEATURES, toxicity.features_of("You 1d10t, loweischaft x WOW!", codes)))
    assert f["hits"] == pytest.approx(math.log(3)) and f["kinds"] == 2 and f["hidden_hits"] == pytest.approx(0.2)
    assert f["near_person"] == 1.0 and f["shouted"] == pytest.approx(0.2) and f["strongest"] == 5.0


WORDS = {"aa": ["kato", "mikone", "tanoki", "sakito", "nokami"], "bb": ["strumpf", "schlacht", "grund", "pfalz", "brunst"],
         "cc": ["élève", "où", "français", "œuvre", "ça"]}


def language_docs():
    rng = random.Random(1)
    docs = []
    for i in range(300):
        lang = rng.choice(sorted(WORDS))
        docs.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 40))), lang, 1, "", ""))
    return docs


def test_language_of_held_out_rows(spark):
    docs = language_docs()
    mixed = " ".join(WORDS["aa"] * 6 + WORDS["bb"] * 3)
    odd = [(900, None, "aa", 1, "", ""), (901, "", None, 1, "", ""), (902, "123 ?! ...", "bb", 1, "", ""), (None, "kato mikone", None, 1, "", ""),
           (903, mixed, None, 1, "", ""), (904, "strumpf grund " * 20000, None, 1, "", "")]
    frame = spark.createDataFrame(docs + odd, DOCS)
    got = {r["doc_id"]: r for r in language.language_id(frame).collect()}
    held = [r for i, r in got.items() if i is not None and i < 300 and r["held_out"]]
    assert held and all(crc(r["doc_id"]) % 4 == 2 for r in held)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]][2] for r in held]) > 0.97
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[None]["lang_pred"] == "aa" and got[904]["lang_pred"] == "bb"
    assert got[903]["languages"] == ["aa", "bb"] and got[903]["shares"] == pytest.approx([2 / 3, 1 / 3], abs=0.05)
    kept = language.keep_languages(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(
        [i for i, *_ in docs if i] + [-1, -1, 903, 904])


def test_language_without_labels(spark):
    frame = spark.createDataFrame([(1, "some text", None, 1, "", "")], DOCS)
    assert language.language_id(frame).first()["lang_pred"] == "und"
    assert language.language_id(frame.where("false")).collect() == []


def test_mixture_climbs():
    rng = np.random.default_rng(0)
    words = np.log(rng.dirichlet(np.ones(3), 50)).astype(np.float32)
    counts = np.array([20, 1, 29])
    _, first = language.mixture(words, counts, np.full((3, 3), 1 / 3))
    share, fit = language.mixture(words, counts, language.mixture(words, counts, np.full((3, 3), 1 / 3))[0])
    assert (fit >= first - 1e-9).all() and share.sum(axis=1) == pytest.approx(1)


PAGES = "page_id long, url string, host string, rule int, chars string"


def plain_verdict(url):
    """Host, path and rule by string operations."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), v, h + p) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, default=(0, None, None))[1:])


def url_rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        host = rng.choice(["www.example.com", "m.example.com", "ab.net", "x.ab.net", "news.org", "shop.org"])
        path = "/" + rng.choice(["en", "es", "fr", "de"]) + "/" + rng.choice(["item", "story", "spam"]) + str(rng.randint(1, 99))
        rows.append((i, f"http{rng.choice(['', 's'])}://{host}{path}{rng.choice(['', '?q=1', '#t', '/'])}"))
    rows += [(500, None), (501, ""), (502, "nothing here"), (503, "HTTP://WWW.Example.COM/en/x"), (504, "http://example.com"),
             (505, "http://com?x=/"), (506, "ftp://notexample.com/en/"), (507, "http://a.net/fr/é#?"), (508, "x://y://net/es/"),
             (None, "http://q.org/en/1"), (3, rows[3][1]), (3, rows[3][1]), (509, "http://z.org/" + "a" * 20000)]
    return rows


def reference_scores(rows):
    """Scores and threshold of the model by dictionaries."""
    urls = sorted({u or "" for _, u in rows})
    chars, verdict = {}, {}
    for u in urls:
        host, path, v, _ = plain_verdict(u)
        rest = u.split("://", 1)[1] if "://" in u else ""
        chars[u], verdict[u] = host + rest[len(host):], v
    return urls, chars, verdict


def test_url_filter(spark):
    rows = url_rows()
    got = url_filter.url_filter(spark.createDataFrame([(i, u, "h", 1, "c") for i, u in rows], PAGES), URL_RULES).collect()
    assert len(got) == len(rows)
    want = Counter((i, *plain_verdict(u)[:2], plain_verdict(u)[3]) for i, u in rows)
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == want
    for r in got:
        assert r["verdict"] in ("allow", "block") and (r["score"] is None) == (r["rule"] is not None)
    decided = {(i): plain_verdict(u)[2] for i, u in rows}
    assert all(r["verdict"] == decided[r["page_id"]] for r in got if r["rule"])

    # The model by dictionaries.
    held = {r["url"]: r["h"] for r in spark.createDataFrame([(u or "",) for _, u in rows], "url string").selectExpr(
        "url", f"pmod(xxhash64(url), {url_filter.HELD_OUT}) = 0 h").collect()}
    urls, chars, verdict = reference_scores(rows)
    n, kinds = {"allow": Counter(), "block": Counter()}, {"allow": {}, "block": {}}
    k = url_filter.ORDER
    for u in urls:
        if verdict[u] and not held[u]:
            s = url_filter.PAD * k + chars[u]
            for j in range(k, len(s)):
                for order in range(k + 1):
                    n[verdict[u]][s[j - order : j], s[j]] += 1
                    kinds[verdict[u]].setdefault(s[j - order : j], Counter())[s[j]] += 1

    def p(kind, context, c):
        shorter = url_filter.UNKNOWN if not context else p(kind, context[1:], c)
        return both(kind, context, c, shorter)

    def both(kind, context, c, shorter):
        seen = kinds[kind].get(context)
        return (seen[c] + len(seen) * shorter) / (seen.total() + len(seen)) if seen else shorter

    for r in got:
        if r["rule"] is None and r["page_id"] is not None and r["page_id"] < 500:
            u = dict(rows)[r["page_id"]]
            s = url_filter.PAD * k + chars[u]
            score = np.mean([math.log(p("allow", s[j - k : j], s[j]) / p("block", s[j - k : j], s[j])) for j in range(k, len(s))])
            assert r["score"] == pytest.approx(score, abs=1e-9)


def test_url_filter_without_rules_or_rows(spark):
    frame = spark.createDataFrame([(1, "http://a.b/c", "", 1, "")], PAGES)
    assert [r["verdict"] for r in url_filter.url_filter(frame, []).collect()] == ["allow"]
    assert url_filter.url_filter(frame.where("false"), URL_RULES).collect() == []


def test_words_that_are_remembered_and_counted_are_bounded(monkeypatch):
    monkeypatch.setattr(toxicity, "CODES", 50)
    codes = toxicity.WordCodes({"bad": 3.0})
    text = " ".join(f"w{i} bad" for i in range(400))
    assert toxicity.features_of(text, codes)[3] == math.log1p(400) and len(codes) <= 50
    batch = pd.DataFrame({"text": [f"alpha{i} beta" for i in range(100)] * 2, "toxic": [1] * 100 + [0] * 100})

    def counts():
        parts = list(toxicity._count_entries(iter([batch])))
        whole = pd.concat(parts).groupby("entry").sum()
        return len(parts), {e: (r.toxic, r.clean) for e, r in whole.iterrows()}

    monkeypatch.setattr(toxicity, "COUNTED", 20)
    many, small = counts()
    monkeypatch.setattr(toxicity, "COUNTED", 1 << 17)
    assert (1, small) == counts() and many > 1 and small["beta"] == (100, 100)


def test_words_of_texts_with_and_without_odd_blanks():
    for t in ("", " ", "a", "a b", " a", "a ", "a  b", "a\u2581b", "a\nb c", "\u2581", "a b "):
        assert pieces.words_in(t) == (pieces.STRETCH.findall("\u2581" + t.replace(" ", "\u2581")) if t else [])


ODD_TEXTS = ["", " ", "a", "the cat, the cat", " a", "a ", "a  b", "a\u2581b", "a\nb c", "\u2581", "  ", "", "\u65e5\u672c \U0001f600 \u00e9t\u00e9", "don't stop.",
             "x" * 60 + " " + "ab, " * 30, "\u0000 q\u0301"]


def test_words_are_numbered_once(monkeypatch):
    words, names = pieces.Words(), {}
    for texts in ([], ODD_TEXTS, ["a new one", "", " a"], [""], ODD_TEXTS[::-1]):
        numbers, ends, before = words.number([pieces.blanked(t) for t in texts])
        assert before == len(names)
        found = [words.known[int(k)].as_py().decode().replace(" ", "\u2581") for k in numbers]
        assert [found[a:b] for a, b in zip(ends[:-1], ends[1:])] == [pieces.words_in(t) for t in texts]
        names |= dict(zip(numbers.tolist(), found))
        assert len(set(names.values())) == len(names) == len(words.known)
    monkeypatch.setattr(pieces, "REMEMBERED", 100)
    assert words.number([b" fresh words"])[2] == 0 and words.known.to_pylist() == [b" fresh", b" words"]


def test_the_library_is_given_equally_frequent_words_at_once(monkeypatch):
    vocabulary = pieces.Vocabulary(MODEL)
    texts = ODD_TEXTS + [" ".join(f"word{i}ing" for i in range(k, 700)) for k in (0, 300)]
    words = pieces.Words()
    numbers = words.number([pieces.blanked(t) for t in texts])[0]
    given, times, model = [], np.bincount(numbers, minlength=len(words.known)), vocabulary.model

    class Counted:
        def encode(self, some, **more):
            given.extend(some if isinstance(some, list) else [some])
            return model.encode(some, **more)

    vocabulary.model = Counted()
    found = vocabulary.library_counts(words.known, times)
    plain = Counter(i for t in texts for i in model.encode(t.replace("\u2581", " ")))
    assert {i: n for i, n in enumerate(found.tolist()) if n} == dict(plain)
    assert len(given) < 40 < 700 < len(words.known)
    assert not vocabulary.library_counts(pieces.Words().known, np.zeros(0, np.int64)).any()


def test_best_paths_of_many_words_are_those_of_one():
    rng = random.Random(4)
    vocabulary = pieces.Vocabulary(MODEL, [-rng.choice([1.0, 2.5, 7.25, 9.0]) for _ in range(32000)])
    words = ["\u2581" * rng.randint(0, 2) + "".join(rng.choice("abeinstr.,\n\u00e9\u65e5\U0001f600") for _ in range(rng.randint(1, 14))) for _ in range(500)] + [""]
    for word, found in zip(words, vocabulary.best_of_words(words), strict=True):
        assert found == vocabulary.best(word)
    assert vocabulary.best_of_words([]) == []


def test_what_is_remembered_does_not_change_the_n_best(monkeypatch):
    rng = random.Random(6)
    texts = ODD_TEXTS + [" ".join(rng.choice(["the", "cat", "sat,", "word%d" % rng.randint(0, 99), "\u65e5\u672c"]) for _ in range(50)) for _ in range(40)]
    whole = pieces.Encoder(MODEL, 4).encode_texts([pieces.blanked(t) for t in texts])
    encoder = pieces.Encoder(MODEL, 4)
    assert [encoder.decode(f[0][1]) for f in whole] == [t.replace("\u2581", " ") for t in texts]
    monkeypatch.setattr(pieces, "REMEMBERED", 500)
    assert [encoder.encode(t) for t in texts] == whole and len(encoder.score) == len(encoder.words.known) < 60
