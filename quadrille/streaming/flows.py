"""Structured Streaming forms of the operators.

Parsing, decoding and routing are stateless, so the batch functions are used on a streaming frame as
they are. What needs state says how long it keeps it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ..functions.terms import is_results_json
from ..operators.graph_log import last_resets, unhidden
from ..schema import (
    OBJECT_COLS,
    QUAD_COLS,
    QUAD_SCHEMA,
    RDF_GRAPH,
    RDF_OBJECT,
    RDF_PREDICATE,
    RDF_SUBJECT,
    statement_set,
)
from ..sources.rdf_lines import parse_statements
from ..sources.writers import DEFAULT_BUCKETS, graph_bucket


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New files under a path as lines, with the file they come from."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("_file"))


def stream_ingest(
    spark: SparkSession, path: str, mode: str = "PERMISSIVE", max_files: int | None = None
) -> DataFrame:
    """Statements of N-Quads files as they arrive."""
    scope = F.concat(F.lower(F.hex(F.xxhash64("_file"))), F.lit("."))
    lines = stream_lines(spark, path, max_files)
    return parse_statements(lines, scope=scope, mode=mode).drop("_file")


def stream_route(requests: DataFrame) -> DataFrame:
    """One query with a ``route`` column instead of a query per branch."""
    from ..operators.requests import route

    return requests.withColumn("route", route())


def stream_decode(responses: DataFrame) -> DataFrame:
    """Outcome of each response by the rules of its ``route``, in one pass."""
    from ..operators.solutions import parse_results, results_complete
    from ..functions.terms import TEXT_BOOLEAN, media_type, parse_boolean

    failed = F.col("transport_error").isNotNull()
    ok = F.coalesce(F.col("status") == 200, F.lit(False)) & ~failed
    doc = F.when(ok & is_results_json("content_type"), parse_results("body"))
    boolean = media_type("content_type") == TEXT_BOOLEAN
    success = (
        F.when(F.col("route") == "query", F.coalesce(results_complete(doc), F.lit(False)))
        .when((F.col("route") == "update") & boolean, ok & F.coalesce(parse_boolean("body"), F.lit(False)))
        .otherwise(ok)
    )
    return responses.select("request_id", "route", "status", success.alias("success"))


def stream_dedup(quads: DataFrame, event_time: str | None = None) -> DataFrame:
    """Each statement once. With an event time column that has a watermark, a statement is forgotten
    when the watermark has passed it; without one the state grows with the number of statements."""
    if event_time is None:
        return quads.dropDuplicates(QUAD_COLS)
    return quads.dropDuplicatesWithinWatermark(QUAD_COLS)


def stream_zip(
    requests: DataFrame, responses: DataFrame, request_time: str, response_time: str,
    within: str, late: str,
) -> DataFrame:
    """Requests with their responses, which come ``within`` an interval after them.

    Watermarks and the time bound let both sides forget rows that can no longer match.
    """
    q = requests.withWatermark(request_time, late).alias("q")
    a = responses.withWatermark(response_time, late).alias("a")
    on = (
        (F.col("q.request_id") == F.col("a.request_id"))
        & (F.col(f"a.{response_time}") >= F.col(f"q.{request_time}"))
        & (F.col(f"a.{response_time}") <= F.col(f"q.{request_time}") + F.expr(f"interval {within}"))
    )
    rest = [F.col(f"a.{c}") for c in responses.columns if c not in requests.columns]
    return q.join(a, on).select("q.*", *rest)


# --- de-reification ---------------------------------------------------------------------------

_PARTS = {RDF_SUBJECT: "s", RDF_PREDICATE: "p", RDF_OBJECT: "o", RDF_GRAPH: "g"}
DEREIFIED_SCHEMA = ", ".join(f"{c} string" for c in ["doc", "node", *QUAD_COLS, "error"])
#: Nodes are kept in so many groups, as a call costs far more than a node.
NODE_GROUPS = 1 << 13
#: What is kept of a group, as JSON: document and label of each node, when it is due, when its timer is up, and its parts, NULL
#: once it was complete.
_GROUP_STATE = "nodes string"


def _collector(keep_ms: int) -> Callable:
    """What is done with a group of nodes. The function is made here so that it travels to the workers by value."""
    parts_of, columns = dict(_PARTS), list(QUAD_COLS)

    def collect(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Keeps the parts of each node until there are four, and remembers it until its time is up.

        The time of a node is the latest event time of its parts and ``keep_ms`` more. Parts that come again are
        ignored, also after the node was complete. A row in and a row out is one text, as frames with many
        columns cost more than what is done with them.
        """
        out = []
        now = state.getCurrentWatermarkMs()
        nodes = {(n[0], n[1]): n for n in json.loads(state.get[0])} if state.exists else {}

        def put(node: tuple, error: str | None, **values: str | None) -> None:
            filled = {"doc": node[0], "node": node[1], "error": error, **values}
            out.append(json.dumps({c: v for c, v in filled.items() if v is not None}))

        if not state.hasTimedOut:
            touched = {}
            for batch in batches:
                rows = json.loads("[" + ",".join(batch["said"].tolist()) + "]")
                for at, (doc, s, p, *term) in zip(batch["at_ms"].tolist(), rows):
                    name = (doc, s)
                    node = nodes.get(name)
                    if node is not None:
                        touched[name] = node
                    part = parts_of.get(p)
                    if part is None:
                        put(name, f"not a part of a reified statement: {p}")
                        continue
                    if node is None:
                        node = nodes[name] = touched[name] = [doc, s, 0, 0, {}]
                    node[2] = max(node[2], int(at) + keep_ms)
                    if node[4] is not None:
                        node[4].setdefault(part, term)
            for name, node in touched.items():
                if node[4] is not None and len(node[4]) == 4:
                    s, p, o, g = (node[4][x] for x in "spog")
                    put(name, None, **dict(zip(columns, (g[0], s[0], s[1], p[0], *o))))
                    node[4] = None
                # A time that has passed already is up at the next move of the watermark.
                node[3] = max(node[2], now, 1)
        for name in [name for name, node in nodes.items() if node[3] < now]:
            parts = nodes.pop(name)[4]
            if parts:
                put(name, "incomplete reified statement, no " + ", ".join(sorted(set(parts_of.values()) - set(parts))))
        if nodes:
            state.update((json.dumps(list(nodes.values())),))
            state.setTimeoutTimestamp(min(node[3] for node in nodes.values()))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({"said": out})

    return collect


def stream_dereify(triples: DataFrame, event_time: str, late: str, keep_ms: int, groups: int = NODE_GROUPS) -> DataFrame:
    """Quads of reified statements whose four parts may arrive in any order and batch.

    ``triples``: ``doc``, triple columns and an event time. A quad comes out with its fourth part. A
    node still incomplete ``keep_ms`` of event time after its latest part comes out as an ``error`` row
    and is forgotten; a complete one is remembered as long, so that repeated parts give nothing new. This is
    the one stateful operator that needs Python: the built-in aggregates either wait for the watermark or
    never forget. Nodes are kept in ``groups`` by their hash: a group costs one call and one value of the state store in each
    batch that has rows of it, however many nodes it holds. Their number is part of the checkpoint. The state of a group
    travels with its rows. It runs on the RocksDB state store, which it sets for the session.
    """
    triples.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    said = F.to_json(F.array(F.col("doc").cast("string"), "s", "p", *OBJECT_COLS))
    timed = triples.withWatermark(event_time, late).select(
        F.pmod(F.xxhash64("doc", "s"), F.lit(groups)).alias("nodes"),
        F.unix_millis(F.col(event_time).cast("timestamp")).alias("at_ms"), said.alias("said"), event_time)
    rows = timed.groupBy("nodes").applyInPandasWithState(
        _collector(keep_ms), "said string", _GROUP_STATE, "append", "EventTimeTimeout")
    return rows.select(F.from_json("said", DEREIFIED_SCHEMA, {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}).alias("r")).select("r.*")


# --- graph log --------------------------------------------------------------------------------


#: So many segments of one tier are merged to one of the next.
FAN_IN = 8
_ROWS = "seq bigint, " + ", ".join(f"{c} string" for c in QUAD_COLS)
_RESET = "g string, reset bigint"


class GraphLogSink:
    """A graph store as a log of segments: every batch of operations adds one, of its own size.

    A segment holds the statements a batch adds, each with the ``seq`` of its operation, and per graph the ``seq`` of the
    last operation that emptied it. The state is put together when it is read: all statements but those of a graph
    that was emptied later. So nothing depends on the order in which batches come. When ``FAN_IN`` segments of a
    tier have piled up they are merged to one of the next, which drops what they hide from each other; a statement
    is written once per tier, and a store of n batches has tiers as the logarithm of n.

    A manifest per version lists its segments. A batch that runs again after a failure starts from the version before
    it and overwrites its own work, so it counts once. Segments that were merged stay for the versions that list them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS):
        """Statements are clustered by so many ``buckets`` of graphs within a segment."""
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _segment(self, first: int, last: int) -> str:
        return f"{self.path}/segments/v{first:012d}-{last:012d}"

    def _manifest(self, version: int) -> list[tuple[int, int, int]] | None:
        """``first, last, tier`` of each segment in order; None when there is no such version.

        Every row says how many there are, so a manifest that a crash left half written counts as none.
        """
        folder = f"{self.path}/manifest/v{version:012d}"
        try:
            rows = self.spark.read.schema("first bigint, last bigint, tier int, of int").json(folder).collect()
        except AnalysisException:
            return None
        if not rows or len(rows) != rows[0]["of"]:
            return None
        return sorted((r["first"], r["last"], r["tier"]) for r in rows)

    def manifest_before(self, batch_id: int) -> list[tuple[int, int, int]]:
        """The manifest of the newest version older than the batch, which mostly is the one just before."""
        found = self._manifest(batch_id - 1) if batch_id else []
        if found is None:
            older = [v for v in self.versions() if v < batch_id]
            found = self._manifest(older[-1]) if older else []
        return found

    def versions(self) -> list[int]:
        """Batch ids of all whole manifests, in order; one job lists them all."""
        try:
            rows = self.spark.read.schema("of int").json(f"{self.path}/manifest/*")
        except AnalysisException:
            return []
        version = F.regexp_extract(F.col("_metadata.file_path"), "/v([0-9]{12})/", 1).cast("bigint").alias("v")
        whole = rows.groupBy(version).agg(F.count("*").alias("n"), F.max("of").alias("of")).where("n = of")
        return sorted(r["v"] for r in whole.collect())

    def _read(self, segments: list[tuple[int, int, int]]) -> tuple[DataFrame, DataFrame]:
        """Statements of the segments that none of them hides, with their ``seq``, and the last reset of each graph."""
        folders = [self._segment(first, last) for first, last, _ in segments]
        rows = self.spark.read.schema(_ROWS).parquet(*[f + "/rows" for f in folders])
        resets = self.spark.read.schema(_RESET).parquet(*[f + "/resets" for f in folders])
        resets = resets.groupBy("g").agg(F.max("reset").alias("reset"))
        return unhidden(rows, resets), resets

    def _write(self, first: int, last: int, rows: DataFrame, resets: DataFrame) -> None:
        folder = self._segment(first, last)
        whole = rows.groupBy(F.struct(*QUAD_COLS).alias("q")).agg(F.max("seq").alias("seq")).select("seq", "q.*")
        # Dealt by hash: a range partitioning sends samples to the driver for every segment, whatever its size. A bucket that is
        # hot is split by adaptive execution, small ones are put together.
        dealt = whole.withColumn("_bucket", graph_bucket("g", self.buckets)).hint("rebalance", "_bucket")
        clustered = dealt.sortWithinPartitions("g", "p", "s").drop("_bucket")
        clustered.write.mode("overwrite").parquet(folder + "/rows")
        resets.write.mode("overwrite").parquet(folder + "/resets")

    def state(self, version: int | None = None) -> DataFrame:
        """All quads after the batch with that id, after the last batch without one."""
        if version is None:
            version = max(self.versions(), default=-1)
        segments = self._manifest(version)
        if not segments:
            return self.spark.createDataFrame([], QUAD_SCHEMA)
        rows, _ = self._read(segments)
        # One segment holds each statement once.
        return statement_set(rows, is_set=len(segments) == 1)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """``batch``: ``seq, op, g`` and the triple columns, one row per payload statement, or one row
        with NULL triple for an operation without payload."""
        resets = last_resets(batch)
        rows = batch.where(F.col("s").isNotNull() & F.col("op").isin("PUT", "POST")).select("seq", *QUAD_COLS)
        self._write(batch_id, batch_id, unhidden(rows, resets), resets)
        segments = [*self.manifest_before(batch_id), (batch_id, batch_id, 0)]
        while len(segments) >= FAN_IN and len({tier for *_, tier in segments[-FAN_IN:]}) == 1:
            merged = segments[-FAN_IN:]
            first, last, tier = merged[0][0], merged[-1][1], merged[0][2] + 1
            self._write(first, last, *self._read(merged))
            segments = [*segments[:-FAN_IN], (first, last, tier)]
        listed = self.spark.createDataFrame(
            [(*s, len(segments)) for s in segments], "first bigint, last bigint, tier int, of int")
        listed.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v{batch_id:012d}")


def stream_graph_log(log: DataFrame, sink: GraphLogSink, checkpoint: str):
    """Start replaying a stream of operations into a sink; returns the query."""
    return (
        log.writeStream.foreachBatch(sink.apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
