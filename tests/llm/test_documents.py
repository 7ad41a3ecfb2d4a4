"""Sharding, fingerprints, pieces, pages and neighbours against plain versions."""

import hashlib
import random
import re
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import fingerprints, html_text, neighbours, pieces, sharding
from quadrille.session import stage

public = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, part int, k1 string, row string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "r") for i, t in rows], DOCS)


def some_rows():
    rng = random.Random(9)
    rows = [(i, "text " * rng.randint(0, 60) + str(rng.random())) for i in range(0, 500, 2)]
    rows += [(1000 + i, "the very same text of a large group") for i in range(250)]
    return rows + [(1, None), (3, ""), (None, "no id"), (None, None), (5, "twice"), (5, "twice"), (7, "ü😀" * 40000)]


def test_shards(spark):
    rows = some_rows()
    got = sharding.shard_documents(docs(spark, rows), 8).toPandas()
    assert len(got) == len(rows) and set(got.columns) == {"doc_id", "text", "part", "k1", "row", "size", "shard", "slot"}
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 16 for _, t in rows)
    assert got["shard"].between(0, 7).all()
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    # A range of the order can be off by half a row at each end, or the tolerance.
    total = got["size"].sum()
    small = got[got["text"].fillna("").str.len() < 1000]
    assert small.groupby("shard")["size"].sum().max() <= total / 8 + small["size"].max() + 0.01 * total
    assert got[got["text"] == "twice"]["shard"].nunique() == 1


def test_sharding_splits_repeated_rows(spark):
    got = sharding.shard_documents(docs(spark, [(1, "same")] * 400), 4).toPandas()
    assert sorted(got.groupby("shard").size()) == [100] * 4


def test_sharding_of_few_and_no_rows(spark):
    assert len(sharding.shard_documents(docs(spark, [(1, "a"), (2, "b")]), 40).collect()) == 2
    assert sharding.shard_documents(docs(spark, []), 40).collect() == []


def test_splitters_are_exact(spark):
    sizes = spark.range(3000).select(F.xxhash64("id").alias("k1"), F.lit(0).cast("long").alias("k2"),
                                     F.lit(0).cast("long").alias("k3"), (F.col("id") % 90 + 1).alias("size"))
    rows = stage(sizes, "sizes")
    cuts = sharding.splitters(rows, 7, 0.01)
    p = rows.toPandas()
    shard = sharding.cell_of(cuts, p["k1"].to_numpy(), p["k2"].to_numpy(), p["k3"].to_numpy())
    weights = np.bincount(shard, weights=p["size"], minlength=7)
    assert np.abs(np.cumsum(weights)[:-1] - p["size"].sum() * np.arange(1, 7) / 7).max() <= 0.01 * p["size"].sum() / 7


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PART_BYTES", 4000)
    rows = [(i, t) for i, t in some_rows() if i is not None and i < 1000 and i != 5] + [(1100, "a b c d e f g"), (1101, "a b c d e f g"), (1102, " ")]
    rows.sort()
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs(spark, shuffled)).collect()}
    assert len(got) == len(rows)
    minhash = fingerprints.MinHash()
    texts = [t or "" for _, t in rows]
    own = minhash.signatures([t.encode() for t in texts])
    for k, (i, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(rows)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        other = minhash.signatures([changed.encode()])
        assert r["fingerprint"] == fingerprints.fingerprint(own[k : k + 1])[0]
        assert r["edited_fingerprint"] == fingerprints.fingerprint(other)[0]
        assert r["near_edited"] == pytest.approx(float(fingerprints.likeness(own[k : k + 1], other)[0]))
        assert 0 <= r["near_next"] <= 1
    assert got[1100]["near_next"] == 1.0 and got[1101]["near_next"] == 0.0
    assert fingerprints.fingerprint_documents(docs(spark, [])).collect() == []
    one = fingerprints.fingerprint_documents(docs(spark, [(1, "x y")])).collect()
    assert [r["near_next"] for r in one] == [1.0]
    odd = fingerprints.fingerprint_documents(docs(spark, [(None, "a"), (None, "b"), (4, None), (4, None)])).collect()
    assert len(odd) == 4


def test_likeness_follows_jaccard():
    minhash = fingerprints.MinHash()
    a = [f"w{i}" for i in range(2000)]
    b = a[:1000] + [f"v{i}" for i in range(1000)]
    s = minhash.signatures([" ".join(a).encode(), " ".join(b).encode()])
    assert float(fingerprints.likeness(s[:1], s[1:])[0]) == pytest.approx(1 / 3, abs=0.13)


MODEL = public.path("piece_bpe_32k.model")


def every_segmentation(vocabulary, text):
    into, _ = vocabulary.lattice(text)
    paths = {0: [(0.0, ())]}
    for j in range(1, len(text) + 1):
        paths[j] = [(a + s, c + ids) for i, s, ids in into[j] for a, c in paths[i]]
    return paths[len(text)]


def test_n_best_of_all_segmentations():
    encoder = pieces.Encoder(MODEL, 4)
    rng = random.Random(1)
    texts = ["the cat", "hello, world", " a  b", "don't stop", "x\n\ny", "日本 é😀", "aaaaaa", "   ", "ab.cd,ef", "a.", ".a", "ab,", ",;" * 3]
    for text in texts + ["".join(rng.choice("abn ,.e") for _ in range(9)) for _ in range(30)]:
        found = [(s, tuple(np.frombuffer(i, "<u4").tolist())) for s, i in encoder.encode(text)]
        whole = every_segmentation(encoder.vocabulary, pieces.SPACE + text.replace(" ", pieces.SPACE))
        assert [s for s, _ in found] == sorted((s for s, _ in whole), reverse=True)[:4]
        assert len(set(found)) == len(found) and set(found) <= set(whole)


def test_long_texts_without_words():
    encoder = pieces.Encoder(MODEL, 4)
    for text in (",;" * 20000, "ab" * 10000, "x." * 5000 + " " + "q" * 3000):
        found = encoder.encode(text)
        assert 1 <= len(found) <= 4 and all(encoder.decode(i) == text for _, i in found)


def test_pieces_round_trip(spark):
    rows = some_rows() + [(9, "tab\tline\nfeed  two"), (11, "👩‍👩‍👧 \u0000 ok")]
    coded = pieces.encode_n_best(docs(spark, rows), MODEL)
    best = pieces.decode(coded.withColumn("first", F.col("ids")[0]), MODEL, "first").collect()
    assert len(best) == len(rows) and all(r["decoded"] == (r["text"] or "") for r in best)
    digest = pieces.encoding_digest(docs(spark, rows), MODEL).collect()
    assert all(r["round_trip"] and r["crc32s"][0] == r["ids_crc32"] and r["scores"] == sorted(r["scores"], reverse=True) for r in digest)
    assert pieces.encoding_digest(docs(spark, []), MODEL).collect() == []


ARTICLE = "<article class='story-12'><h1>Head &amp; line</h1><p>One   two\n three<p>four <b>five</b> six</p><ul><li>a<li>b</ul></article>"
WANT = "Head & line\nOne two three\nfour five six\na\nb"


@pytest.mark.parametrize("html, want", [
    (f"<body><header><h1>Site</h1></header><nav><a href=x>home</a></nav>{ARTICLE}<footer>foot</footer>", WANT),
    (f"<div class='sidebar'><p>{'side ' * 9}</div><main>{ARTICLE}</main><div id='comments'><p>{'nice post ' * 5}</p></div>", WANT),
    (f"<script>var x = '<p>no</p>';</script><style>p{{}}</style><div class=cookie-notice>We use cookies</div>{ARTICLE}", WANT),
    (f"<form><input><label>Your name</label></form>{ARTICLE}<aside>related</aside><!-- <p>no</p> -->", WANT),
    ("<div class='post-content'><p>Some text here that is long</p><p>before <span class=ad>buy now</span> after</p></div>",
     "Some text here that is long\nbefore after"),
    ("<p>a < b &lt;i&gt; &#x41;&eacute;&nbsp;z</p>", "a < b <i> Aé z"), ("plain", "plain"), ("", ""), ("<p>", ""),
    ("<div><p hidden>no</p><p>yes</p></div>", "yes"), ("<table><tr><td>a<td>b</table>", "a\nb"), ("<p>open <b>tag", "open tag")])
def test_blocks_of_an_article(html, want):
    assert html_text.Page(html).text([]) == want


LONG = "many words of the story " * 40


@pytest.mark.parametrize("html, want", [
    (f"<body><article><h1>T</h1><p>intro</p><div class='body'><p>{LONG}</p></div><p>end</p></article>", ["T", "intro", LONG, "end"]),
    (f"<article><div class=lead><p>first</p></div><div class=body><p>{LONG}</p></div></article>", ["first", LONG]),
    (f"<body><div id=page><div class=lead><p>first</p></div><div class=body><p>{LONG}</p></div><div class=more><a href=x>other story</a></div></div>",
     ["first", LONG]),
    (f"<body><main><h1><a href=x>T</a></h1><article><section><p>{LONG}</p></section><ul><li><a href=x>source</a></ul></article></main>",
     ["T", LONG, "source"]),
    (f"<body><h1>T</h1><div class=body><p>{LONG}</p></div><p>end</p><ul><li><a href=x>home</a></ul><div class=chat>x</div>", ["T", LONG, "end"])])
def test_all_of_an_article_around_its_core(html, want):
    assert html_text.Page(html).text([]) == "\n".join(w.strip() for w in want)


def test_whole_articles_by_the_paths_of_a_host(spark):
    page = "<body><article><h1>T{n}</h1><p>intro</p><div class=lead>lead {n}</div><div class=body><p>{body}</p></div><p>end</p></article>"
    rows = [(n, f"http://n.org/{n}", page.format(n=n, body=LONG if n else "short")) for n in range(6)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {
        n: f"T{n}\nintro\nlead {n}\n{LONG.strip() if n else 'short'}\nend" for n in range(6)}


@pytest.mark.parametrize("html, want", [
    ("<article><p>a <a style='text-decoration:none'>word</a> and <span style='border:none'>more</span></p></article>", "a word and more"),
    ("<article><p>a <span style='display: none'>not</span> b</p></article>", "a b"),
    *((f"<body><div class='{c}'><article><p>story</p></article></div>", "story")
      for c in ("overflow-hidden", "no-sidebar", "with-sidebar", "page-header-content", "sidebar", "widget")),
    ("<body><div class='has-sidebar-left'><p>story</p></div><div class='left-sidebar'><p>side</p></div>", "story"),
    (f"<body><div class='header'><h1>T</h1><p>{LONG}</p></div><p>end</p>", f"T\n{LONG.strip()}\nend"),
    (f"<article><p>story</p></article><div class='comments-area'><article class='comment-body'><p>{LONG}</p></article></div>", "story"),
    ("<main><article class='share'><p>one</p></article><article><p>and two</p></article></main>", "one\nand two"),
    (f"<div class='post'><p><span class='share'>{LONG}</span> end</p></div>", LONG + "end"),
    ("<article><p>a <svg viewBox='0 0 1 1'/> b</p><p>c <math/> d</p></article>", "a b\nc d"),
    ("<article><svg><path/><p>a</p></article>", "a"), ("<article><p>a<svg><text>no</text></svg> b</p></article>", "a b")])
def test_names_and_styles_that_do_not_mute(html, want):
    assert html_text.Page(html).text([]) == want


def test_host_paths_win(spark):
    page = "<body><div class='c{n}'><p>{body}</p></div><div class='chat'><p>{noise}</p></div></body>"
    rows = [(i, f"http://h.org/{i}", page.format(n=i, body="good words here " * 20, noise="x")) for i in range(9)]
    rows += [(50, "http://h.org/50", page.format(n=50, body="short", noise="much longer noise " * 30)),
             (51, None, "<p>alone</p>"), (52, "http://h.org/52", None), (53, "http://k.org/", "<p>" + "long &amp; " * 40000), (50, "http://h.org/50", "")]
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, text int")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.main_text(frame).collect()), key=str)
    by_id = {i: t for i, t, _ in got if t}
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert by_id[3] == ("good words here " * 20).strip() and by_id[50] == "short" and by_id[51] == "alone" and 52 not in by_id
    assert by_id[53] == ("long & " * 40000).strip()
    assert html_text.main_text(frame.where("false")).collect() == []


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()} == want


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, part int, vector int")


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.5 * rng.standard_normal((1500, 16))).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] + [1.0] * 15), (5004, [None] + [1.0] * 15),
           (5005, [float("inf")] * 16), (5006, [1.0] * 3), (None, [1.0] * 16), rows[3], rows[20]]
    got = neighbours.nearest_neighbours(vectors(spark, rows + odd), F.col("vec_id") % 20 == 0, 20).toPandas()
    y = x.astype(np.float64)
    queries = np.arange(0, 1500, 20)
    assert set(got["query_id"]) == set(queries) and (got.groupby("query_id").size() == 20).all()
    hits = 0
    for q, g in got.sort_values(["query_id", "rank"]).groupby("query_id"):
        score = (y[q] * y).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(1500), -score))[:20]
        hits += len(set(best) & set(g["vec_id"]))
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g["vec_id"])
        assert g["score"].to_numpy() == pytest.approx(score[g["vec_id"]], abs=1e-12)
        assert list(zip(-g["score"], g["vec_id"])) == sorted(zip(-g["score"], g["vec_id"]))
    assert hits / (20 * len(queries)) >= 0.9


@pytest.mark.parametrize("kind", ["random", "centres"])
def test_recall_on_more_rows_than_the_sample(spark, kind):
    rng = np.random.default_rng(8)
    n, sample = 6000, 1024
    x = rng.standard_normal((n, 24))
    if kind == "centres":
        x = 3 * rng.standard_normal((60, 24))[rng.integers(0, 60, n)] + x
    x[1000:3000] = x[1000]
    x = x.astype(np.float32).astype(np.float64)
    rows = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = neighbours.nearest_neighbours(rows, F.col("vec_id") % 20 == 0, 20, sample).toPandas()
    hits = {}
    for q, g in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        # Copies tie: any that scores as well as the twentieth is a neighbour.
        least = np.partition(score, n - 20)[n - 20] - 1e-9
        hits[q] = (score[g["vec_id"]] >= least).sum()
    assert len(hits) == n // 20
    # Queries that are copies of the hot vector do not count: they find each other in any case.
    recall = sum(h for q, h in hits.items() if not 1000 <= q < 3000) / (20 * sum(not 1000 <= q < 3000 for q in hits))
    print("recall", kind, recall)
    assert recall >= neighbours.RECALL


def test_probes_are_chosen_on_vectors_that_were_not_learned(spark, monkeypatch):
    x = np.random.default_rng(3).standard_normal((600, 8)).astype(np.float32)
    learned, asked = [], []
    train, probes_for = neighbours.Router.__init__, neighbours.probes_for
    monkeypatch.setattr(neighbours.Router, "__init__", lambda self, x, *a: (learned.extend(map(tuple, x)), train(self, x, *a))[1])

    def probes(*args):
        asked.extend(tuple(v) for a in args if isinstance(a, np.ndarray) and a.ndim == 2 and a.dtype == np.float64 for v in a)
        return probes_for(*args)

    monkeypatch.setattr(neighbours, "probes_for", probes)
    neighbours.nearest_neighbours(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % 20 == 0)
    assert len(asked) >= 32 and not set(asked) & set(learned)


def test_neighbours_of_few_rows(spark):
    few = neighbours.nearest_neighbours(vectors(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0]), (20, [2.0, 0.0])]), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, few.collect())) == [(0, 1, 20, 2.0), (0, 2, 7, 1.0), (20, 1, 0, 2.0), (20, 2, 7, 2.0)]
    assert neighbours.nearest_neighbours(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest_neighbours(vectors(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_balanced_parts():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((333, 8))
    label = neighbours.balanced_parts(neighbours.neighbour_graph(x, 8), 8, rng)
    assert np.bincount(label, minlength=8).max() - np.bincount(label, minlength=8).min() <= 4


def test_pieces_by_likelihood_of_the_table(spark):
    rows = [(i, t) for i, t in enumerate(["understanding the international community", "", None, "a  b ", " ", "日本 \U0001f600", "the the"])]
    scores = pieces.piece_log_probabilities(docs(spark, rows), MODEL)
    vocabulary = pieces.Vocabulary(MODEL, scores)
    plain = np.ones(len(scores))
    for _, text in rows:
        for i in vocabulary.model.encode(text or ""):
            plain[i] += 1
    assert np.allclose(scores, np.log(plain / plain.sum()))
    encoder = pieces.Encoder(MODEL, 4, scores)
    words = ["▁understanding", "▁the", "▁▁b", "▁日本\U0001f600", "▁", "▁tttttttttttt", "▁the\nend."]
    for word, (score, ids, loss) in zip(words, vocabulary.best_of_words(words)):
        whole = sorted(every_segmentation(vocabulary, word), reverse=True)
        assert np.isclose(score, whole[0][0]) and np.isclose(loss, whole[0][0] - whole[1][0] if len(whole) > 1 else np.inf)
        assert (score, ids) == vocabulary.best(word)[:2]
    assert encoder.encode("understanding the international community")[0][1] == np.array(
        vocabulary.model.encode("understanding the international community"), "<u4").tobytes()
    assert pieces.piece_log_probabilities(docs(spark, []), MODEL) == [np.log(1 / len(scores))] * len(scores)


def test_tiles_move_rows_of_probed_parts_only(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLAB", 50)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    # Part 0 has 120 rows, part 1 has 30, part 2 has 10 that no query probes, part 3 is probed but empty.
    rows = [(i, [float(i)], [0 if i < 120 else 1 if i < 150 else 2]) for i in range(160)]
    rows = [(i, v, [p[0], (p[0] + 1) % 2, 3]) if i % 20 == 0 else (i, v, p) for i, v, p in rows]
    routed = spark.createDataFrame(rows, "vec_id long, vector array<double>, parts array<int>")
    left, right = (d.cache() for d in neighbours.tiles(routed, F.col("vec_id") % 20 == 0))
    # 8 queries in two blocks of both parts, so 150 rows twice; 8 queries to three slabs and to one.
    assert right.count() == 2 * 150 and left.count() == 8 * 3 + 8
    met = left.join(right, ["part", "slab", "block"]).select("query_id", "vec_id").collect()
    assert sorted(map(tuple, met)) == sorted((q, r) for q in range(0, 160, 20) for r in range(150))


def test_ties_in_bounded_memory():
    import tracemalloc
    n = 16_384
    rows = np.tile(np.random.default_rng(1).standard_normal(64), (n, 1))
    ids = np.arange(n)[::-1].copy()
    tracemalloc.start()
    q, r, s = neighbours.best_of_block(rows[:512], ids[:512], rows, ids, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20 and len(q) == 512 * 20 and set(r) == set(range(20)) and len(set(s)) == 1
