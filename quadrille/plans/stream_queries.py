"""Queries that run as streams to the end of their input. Their SQL is that of the batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import construct
from ..schema import QUAD_COLS, TRIPLE_COLS
from ..session import fresh_path, stage
from ..sources import writers
from ..streaming import flows
from . import graph_queries  # noqa: F401  (its SQL is used here)
from . import views as V
from .registry import ORACLES, query

C, TRIPLE = V.COLS, ", ".join(TRIPLE_COLS)


def _replay(spark, frame, name):
    """A frame as the files of a stream, with its schema."""
    path = fresh_path(spark, name)
    frame.write.parquet(path)
    return spark.readStream.schema(frame.schema).parquet(path)


def _finished(spark, stream, name):
    out = fresh_path(spark, name)
    flows.run_to_parquet(stream, out, fresh_path(spark, name + "-state"))
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_ingest", f"WITH quads AS ({V.QUADS_SQL}) SELECT {C} FROM quads")
def stream_ingest(spark, sf_dir):
    path = fresh_path(spark, "stream-nq")
    writers.write_nquads(V.quads(spark, sf_dir), path)
    return _finished(spark, flows.stream_ingest(spark, path), "ingested").select(*QUAD_COLS)


@query(
    "stream_decode",
    f"WITH responses AS ({V.RESPONSES_SQL}) SELECT request_id, route, status, coalesce(CASE route "
    "WHEN 'query' THEN body LIKE '%bindings%' WHEN 'update' THEN status = 200 AND (content_type NOT LIKE 'text/boolean%' "
    "OR lower(body) = 'true') ELSE status = 200 END, false) AS success FROM responses",
)
def stream_decode(spark, sf_dir):
    stream = _replay(spark, V.responses(spark, sf_dir), "stream-responses")
    return _finished(spark, flows.stream_decode(stream), "decoded")


@query(
    "stream_route",
    "SELECT o_orderkey AS request_id, CASE WHEN o_orderstatus = 'F' THEN 'update' WHEN o_orderpriority = '3-MEDIUM' THEN 'construct' "
    "WHEN o_orderpriority = '5-LOW' THEN 'query.streamed' ELSE 'query.mapped' END AS route FROM orders",
)
def stream_route(spark, sf_dir):
    requests = V.requests(spark, sf_dir).select("request_id", "kind", "query_type")
    routed = flows.stream_route(_replay(spark, requests, "stream-requests"))
    return _finished(spark, routed.select("request_id", "route"), "routed")


_PRIORITY = f"SELECT {C} FROM ({V.entity_sql(V.BY_TABLE['orders'])}) WHERE p = 'urn:p:o_orderpriority'"


@query("stream_dedup", f"{_PRIORITY} UNION ALL {_PRIORITY}")
def stream_dedup(spark, sf_dir):
    """Statements of orders at the time of the order, in order of time: said again an hour later, which is
    within the bound of a day, and again after 1,000 days, when they are forgotten and count as new."""
    orders = V.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("urn:orders:"), F.col("o_orderkey").cast("string")).alias("s"), F.col("o_orderdate").cast("timestamp").alias("at"))
    quads = V.quads(spark, sf_dir, ["urn:g:orders"]).where("p = 'urn:p:o_orderpriority'").join(orders, "s")
    times = F.array(*(F.col("at") + F.expr(f"interval {later}") for later in ("0 hours", "1 hour", "1000 days")))
    said = quads.select(*QUAD_COLS, F.explode(times).alias("at"))
    path = fresh_path(spark, "stream-quads")
    # Files are read in order of the time they were written; the four of a batch span about a year.
    said = stage(said, "said")
    first, last = said.agg(F.min("at"), F.max("at")).first()
    width = (last - first) / 9 if first is not None else None
    for k in range(9 if first is not None else 0):
        span = (F.col("at") >= F.lit(first + k * width)) & ((F.col("at") < F.lit(first + (k + 1) * width)) if k < 8 else F.lit(True))
        said.where(span).repartition(4).write.mode("append").parquet(path)
    stream = spark.readStream.schema(said.schema).option("maxFilesPerTrigger", 4).parquet(path).withWatermark("at", "1 day")
    return _finished(spark, flows.stream_dedup(stream, "at").select(*QUAD_COLS), "deduplicated")


@query(
    "stream_zip",
    "SELECT event_id AS request_id, event_type AS kind, CAST(floor(value) AS BIGINT) AS answer FROM events",
)
def stream_zip(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    asked = events.select(F.col("event_id").alias("request_id"), F.col("event_type").alias("kind"), F.col("ts").alias("asked"))
    answered = events.select(
        F.col("event_id").alias("request_id"), F.floor("value").alias("answer"),
        (F.col("ts") + F.expr("interval 5 seconds")).alias("answered"),
    )
    zipped = flows.stream_zip(
        _replay(spark, asked.repartitionByRange("asked"), "stream-asked"),
        _replay(spark, answered.repartitionByRange("answered"), "stream-answered"),
        "asked", "answered", within="1 minute", late="1 hour",
    )
    return _finished(spark, zipped.select("request_id", "kind", "answer"), "zipped")


@query(
    "stream_dereify",
    f"WITH quads AS ({V.QUADS_SQL}) SELECT DISTINCT {C} FROM quads WHERE g IN ('urn:g:customer', 'urn:g:nation')",
)
def stream_dereify(spark, sf_dir):
    quads = V.quads(spark, sf_dir, ["urn:g:customer", "urn:g:nation"])
    parts = construct.reify(quads).select(
        F.lit("doc").alias("doc"), *TRIPLE_COLS, F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("at")
    )
    stream = flows.stream_dereify(_replay(spark, parts, "stream-parts"), "at", "1 hour", keep_ms=3_600_000)
    return _finished(spark, stream, "dereified").where("error IS NULL").select(*QUAD_COLS)


#: Rows of the log in one file, and files of one batch.
LOG_FILE, LOG_FILES = 1 << 14, 4


@query("stream_graph_log", ORACLES["graph_log_replay"])
def stream_graph_log(spark, sf_dir):
    """The event log in batches of several files, as many as the log is long; the state after the last batch."""
    log = stage(V.ops(spark, sf_dir).join(V.payload(spark, sf_dir), "seq", "left"), "log")
    files = log.count() // LOG_FILE + LOG_FILES + 1
    path = fresh_path(spark, "stream-log")
    log.repartitionByRange(files, "seq").write.parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", LOG_FILES).parquet(path)
    sink = flows.GraphLogSink(spark, fresh_path(spark, "stream-store"))
    flows.stream_graph_log(stream, sink, fresh_path(spark, "stream-log-state")).awaitTermination()
    return sink.state()
