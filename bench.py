"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs to the end (results go to
a sink that drops them) ``BENCH_RUNS`` times; the best time counts. With one run that is the time of
the first use of a query in a session that has run others before.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from quadrille.plans import catalog, views
from quadrille.session import fresh_path, local_session
from quadrille.sources import rdf_lines, writers
from quadrille.sources.relational import Entity, to_quads

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

QUERIES = [
    "construct_quads", "filter_construct", "bgp_join", "bgp_star", "values_join", "optional_var",
    "paging", "graph_size", "model_distinct", "reify", "dereify", "delete_insert_where", "graph_merge",
    "insert_data", "graph_log_replay", "graph_log_outcomes", "count_window", "rdfs_closure",
    "topk_text", "search_construct", "decode_select", "decode_update", "decode_construct",
    "decode_graph", "read_results_json", "map_solutions", "write_nquads", "read_turtle",
    "read_jsonld", "short_form", "qname_for", "prefix_join", "canonical_request", "parse_request",
    "stream_ingest", "stream_graph_log", "stream_dereify", "construct_reasoning",
]

LINEITEM = Entity(
    "lineitem", "l_key",
    {"l_partkey": "-> part", "l_suppkey": "-> supplier", "l_quantity": "decimal",
     "l_extendedprice": "decimal", "l_returnflag": "string", "l_shipdate": "dateTime"},
    "urn:g:lineitem",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench")
    times: dict[str, float] = {}

    items = views.table(spark, SF_DIR, "lineitem").withColumn(
        "l_key", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    )
    entities = [to_quads(views.table(spark, SF_DIR, e.table), e) for e in views.ENTITIES]
    everything = to_quads(items, LINEITEM)
    for part in entities:
        everything = everything.unionByName(part)
    run(views.quads(spark, SF_DIR))  # warm-up, and the store of the queries below
    run(views.document_quads(spark, SF_DIR))

    stored = fresh_path(spark, "bench-quads")
    times["quad_build"] = timed(lambda: writers.write_quads(everything, stored, is_set=True))
    n_quads = writers.read_quads(spark, stored).count()
    lines = fresh_path(spark, "bench-nq")
    times["nquads_write"] = timed(lambda: writers.write_nquads(writers.read_quads(spark, stored), lines))
    times["nquads_ingest"] = timed(lambda: run(rdf_lines.read_nquads(spark, lines)))

    times["quad_statistics"] = timed(lambda: views.quad_statistics(spark, SF_DIR))

    for name in QUERIES:
        query = catalog.queries()[name]
        times[name] = min(timed(lambda: run(query(spark, SF_DIR))) for _ in range(RUNS))

    out = {
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "quads": n_quads,
        "quads_per_sec": {
            k: round(n_quads / times[k]) for k in ("quad_build", "nquads_write", "nquads_ingest")
        },
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
