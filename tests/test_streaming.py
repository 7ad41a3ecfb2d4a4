import datetime as dt

from pyspark.sql import functions as F

from quadrille.operators import construct
from quadrille.schema import QUAD_COLS, TRIPLE_COLS
from quadrille.streaming import flows

from .data import as_set, frame, rows, text


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def finish(spark, stream, tmp_path, name):
    out = str(tmp_path / name)
    flows.run_to_parquet(stream, out, str(tmp_path / (name + "-state")))
    return spark.read.schema(stream.schema).parquet(out)


def batches(spark, tmp_path, *frames):
    """A stream that reads one file per batch, in this order."""
    path = str(tmp_path / "in")
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.nq").write_text('<urn:a> <urn:p> "x" <urn:g> .\nbroken\n')
    got = finish(spark, flows.stream_ingest(spark, str(tmp_path / "in")), tmp_path, "out")
    assert sorted((r.g or "", r._corrupt_record or "") for r in got.collect()) == [("", "broken"), ("urn:g", "")]


def test_dereify_over_batches_with_timeout(spark, tmp_path):
    parts = construct.reify(frame(spark, rows())).select(F.lit("d").alias("doc"), *TRIPLE_COLS)
    whole = parts.withColumn("late", F.col("p").endswith("graph"))
    lost = text(None, "lonely", "http://www.w3.org/1999/02/22-rdf-syntax-ns#subject", "urn:s")
    first = whole.where("not late").drop("late").unionByName(
        frame(spark, [lost]).select(F.lit("d").alias("doc"), *TRIPLE_COLS)
    ).withColumn("at", F.lit(at(0)))
    second = whole.where("late").drop("late").withColumn("at", F.lit(at(1)))
    # Later events only move time on, past the end of the incomplete node.
    tick = lambda m: second.limit(1).withColumn("s", F.lit(f"tick{m}")).withColumn("at", F.lit(at(m)))
    stream = batches(spark, tmp_path, first, second, tick(30), tick(40))
    got = finish(spark, flows.stream_dereify(stream, "at", "1 minute", keep_ms=600_000), tmp_path, "out")
    assert as_set(got.where("error IS NULL").select(*QUAD_COLS)) == set(rows())
    errors = [(r.node, r.error) for r in got.where("error IS NOT NULL").collect() if not r.node.startswith("tick")]
    assert errors == [("lonely", "incomplete reified statement, no g, o, p")]


def test_dereify_parts_of_one_time_in_many_batches(spark, tmp_path):
    """One part a batch, all of one event time, each sent twice, and once more after the quad."""
    quad = text("urn:g", "urn:s", "urn:p", "v")
    parts = construct.reify(frame(spark, [quad])).select(F.lit("d").alias("doc"), *TRIPLE_COLS).withColumn("at", F.lit(at(0)))
    of = lambda name: parts.where(F.col("p").endswith(name))
    steps = [of(n).unionByName(of(n)) for n in ("subject", "graph", "object", "predicate", "graph")]
    tick = of("subject").withColumn("s", F.lit("tick")).withColumn("at", F.lit(at(40)))
    stream = batches(spark, tmp_path, *steps, tick, tick.withColumn("at", F.lit(at(41))))
    got = finish(spark, flows.stream_dereify(stream, "at", "1 minute", keep_ms=600_000), tmp_path, "out").where("node != 'tick'")
    assert [(r.error, *(r[c] for c in QUAD_COLS)) for r in got.collect()] == [(None, *quad)]


def test_dereify_keeps_nodes_in_groups(spark, tmp_path):
    """Nodes of one group are due at their own times, also in a batch that has rows of the group; it is one row of state."""
    quads = {n: text("urn:g", f"urn:{n}", "urn:p", n) for n in "abc"}
    parts = {n: construct.reify(frame(spark, [q])).select(F.lit("d").alias("doc"), *TRIPLE_COLS).withColumn("s", F.lit(n))
             for n, q in quads.items()}

    def of(node, minute, *names):
        return parts[node].where(F.regexp_extract("p", "#(.*)", 1).isin(*names)).withColumn("at", F.lit(at(minute)))

    whole = ("subject", "predicate", "object", "graph")
    first = of("a", 0, "subject").unionByName(of("b", 0, *whole[:3])).unionByName(of("c", 0, *whole))
    second = of("a", 8, "predicate").unionByName(of("c", 8, "graph"))
    tick = of("a", 13, "subject").withColumn("s", F.lit("tick"))
    last = of("a", 14, "object", "graph")
    stream = flows.stream_dereify(batches(spark, tmp_path, first, second, tick, last), "at", "1 minute", keep_ms=600_000, groups=1)
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert {p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]} == {1}
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert as_set(got.where("error IS NULL").select(*QUAD_COLS)) == {quads["a"], quads["c"]}
    errors = [(r.doc, r.node, r.error) for r in got.where("error IS NOT NULL").collect()]
    assert errors == [("d", "b", "incomplete reified statement, no g")]
    assert got.count() == 3


def test_dedup_over_batches(spark, tmp_path):
    quads = frame(spark, rows())
    stream = batches(spark, tmp_path, quads, quads)
    assert finish(spark, flows.stream_dedup(stream), tmp_path, "out").count() == 24


def test_dedup_within_watermark(spark, tmp_path):
    quads = frame(spark, rows()).withColumn("at", F.lit(at(0)))
    stream = batches(spark, tmp_path, quads, quads).withWatermark("at", "10 minutes")
    assert finish(spark, flows.stream_dedup(stream, "at"), tmp_path, "out").count() == 24


def test_dedup_forgets_while_the_stream_runs(spark, tmp_path):
    """One statement a minute, said again in the next batch within the bound, and much later outside of it."""
    def batch(first, n, shift):
        rows_ = [(*text("urn:g", f"urn:s{i}", "urn:p", "v"), at(0) + dt.timedelta(minutes=i + shift)) for i in range(first, first + n)]
        return spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in QUAD_COLS) + ", at timestamp")

    steps = [batch(0, 100, 0).unionByName(batch(0, 100, 1)), batch(90, 60, 5), batch(1000, 5, 0), batch(2000, 5, 0), batch(0, 10, 3000), batch(4000, 1, 0)]
    stream = batches(spark, tmp_path, *steps).withWatermark("at", "30 minutes")
    query = (
        flows.stream_dedup(stream, "at").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {f"urn:s{i}": 2 if i < 10 else 1 for i in [*range(150), *range(1000, 1005), *range(2000, 2005), 4000]}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) >= 100 and held[-1] < 20


LOG = "seq bigint, op string, g string, s string, s_type string, p string, o string, o_type string, o_datatype string, o_lang string"


def entry(seq, op, g, o=None):
    triple = ("s", "uri", "p", o, "literal", "d", None) if o else (None,) * 7
    return (seq, op, g, *triple)


def test_graph_log_batch_by_batch(spark, tmp_path):
    """Sizes of a graph after replace, replace, merge, replace; another graph stays as it is."""
    sink = flows.GraphLogSink(spark, str(tmp_path / "store"), buckets=4)
    steps = [
        [entry(0, "PUT", "g", "a"), entry(1, "POST", "other", "z"), entry(2, "POST", None, "n")],
        [entry(3, "PUT", "g", "b")], [entry(4, "POST", "g", "c"), entry(5, "POST", "g", "b")],
        [entry(6, "GET", "g")], [entry(7, "PUT", "g", "d")], [entry(8, "DELETE", "g")],
    ]
    sizes = []
    for i, step in enumerate(steps):
        batch = spark.createDataFrame(step, LOG)
        sink.apply(batch, i)
        sink.apply(batch, i)  # a batch that runs again counts once
        state = sink.state(i)
        sizes.append(state.where("g = 'g'").count())
        assert state.where("g = 'other'").count() == 1 and state.where("g IS NULL").count() == 1
    assert sizes == [1, 1, 2, 2, 1, 0]
    assert as_set(sink.state()) == as_set(sink.state(5)) and sink.versions() == list(range(6))


def folders(path):
    return {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in (path / "segments").iterdir()}


def test_a_batch_writes_its_own_size(spark, tmp_path, monkeypatch):
    """Segments of the batches, and merged ones of eight (here of two) of a tier; earlier versions stay readable."""
    monkeypatch.setattr(flows, "FAN_IN", 2)
    sink = flows.GraphLogSink(spark, str(tmp_path / "store"))
    large = spark.range(2000).select(
        F.col("id").alias("seq"), F.lit("POST").alias("op"), F.lit("big").alias("g"), F.col("id").cast("string").alias("s"),
        F.lit("uri").alias("s_type"), F.lit("p").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("o"), F.lit("literal").alias("o_type"),
        F.lit("d").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"))
    sink.apply(large, 0)
    before = folders(tmp_path / "store")
    sizes = []
    for i in range(1, 4):
        sink.apply(spark.createDataFrame([entry(5000 + i, "POST", "big", f"new{i}")], LOG), i)
        sizes.append(sink.state(i).count())
    assert sizes == [2001, 2002, 2003] and sink.state(0).count() == 2000
    made = folders(tmp_path / "store")
    name = lambda a, b: f"v{a:012d}-{b:012d}"
    assert set(made) == {name(i, i) for i in range(4)} | {name(0, 1), name(2, 3), name(0, 3)}
    # A batch of one statement writes a small file, whatever the store holds.
    assert all(made[name(i, i)] < before[name(0, 0)] / 4 for i in (1, 2, 3)) and made[name(2, 3)] < before[name(0, 0)] / 4
    assert sink._manifest(3) == [(0, 3, 2)]


def test_batches_may_come_in_any_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows, "FAN_IN", 3)
    steps = [[entry(0, "POST", "g", "a"), entry(1, "POST", None, "n")], [entry(2, "PUT", "g", "b")], [entry(3, "POST", "g", "c"), entry(4, "DELETE", "h")],
             [entry(5, "POST", "h", "x"), entry(5, "POST", "h", "x")], [entry(6, "DELETE", None)], [entry(7, "POST", None, "m")], [entry(8, "POST", "g", "c")]]
    want = {("g", "b"), ("g", "c"), ("h", "x"), (None, "m")}
    for n, order in enumerate(([0, 1, 2, 3, 4, 5, 6], [6, 3, 5, 1, 0, 4, 2], [5, 4, 3, 2, 1, 0, 6])):
        sink = flows.GraphLogSink(spark, str(tmp_path / f"store{n}"))
        for i, k in enumerate(order):
            sink.apply(spark.createDataFrame(steps[k], LOG), i)
        got = [(r["g"], r["o"]) for r in sink.state().collect()]
        assert len(got) == 4 and set(got) == want


def test_zip(spark, tmp_path):
    asked = spark.createDataFrame([(1, at(0)), (2, at(0)), (3, at(1))], "request_id int, asked timestamp")
    answered = spark.createDataFrame([(1, "ok", at(1)), (2, "late", at(50)), (3, "ok", at(2))], "request_id int, body string, answered timestamp")
    (tmp_path / "q").mkdir()
    (tmp_path / "a").mkdir()
    zipped = flows.stream_zip(
        batches(spark, tmp_path / "q", asked), batches(spark, tmp_path / "a", answered), "asked", "answered", "10 minutes", "5 minutes"
    )
    got = finish(spark, zipped.select("request_id", "body"), tmp_path, "out")
    assert sorted(map(tuple, got.collect())) == [(1, "ok"), (3, "ok")]


def test_state_of_a_node_comes_with_its_rows(spark, tmp_path):
    """A call to the state store per part and node took most of the time."""
    parts = construct.reify(frame(spark, rows())).select(F.lit("d").alias("doc"), *TRIPLE_COLS).withColumn("at", F.lit(at(0)))
    stream = flows.stream_dereify(batches(spark, tmp_path, parts), "at", "1 minute", keep_ms=600_000)
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" in plan and "TransformWithState" not in plan


def test_segments_send_no_samples_to_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    def refuse(*args):
        raise AssertionError("a range partitioning takes samples")

    monkeypatch.setattr(Classic, "repartitionByRange", refuse)
    sink = flows.GraphLogSink(spark, str(tmp_path / "store"), buckets=4)
    quads = frame(spark, rows()).withColumn("seq", F.lit(1).cast("bigint")).withColumn("op", F.lit("POST"))
    sink.apply(quads, 0)
    assert as_set(sink.state()) == set(rows())
