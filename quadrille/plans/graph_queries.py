"""Queries over the quad table: pattern matching, joins, sets, updates, reasoning and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bgp, construct, dataset, graph_log, reasoning, scans, search, update
from ..operators.dataset import page
from ..schema import QUAD_COLS, RDF, RDF_TYPE, RDFS, TRIPLE_COLS, XSD, iri, literal
from . import views as V
from .registry import ORACLES, query

Q = f"WITH quads AS ({V.QUADS_SQL}) "
D = f"WITH docs AS ({V.DOCUMENTS_SQL}) "
C = V.COLS
TRIPLE = ", ".join(TRIPLE_COLS)
NULLS = "NULLS FIRST"
ORDER = ", ".join(f"{c} {NULLS}" for c in QUAD_COLS)

NATION, CUSTOMER, SUPPLIER = "urn:g:nation", "urn:g:customer", "urn:g:supplier"


# --- construct and filters --------------------------------------------------------------------


@query(
    "construct_quads",
    Q + f"SELECT DISTINCT {C} FROM quads WHERE g IN ('{NATION}', '{CUSTOMER}') "
    f"AND p IN ('urn:p:n_regionkey', 'urn:p:c_nationkey') "
    "AND o_type = 'uri' AND o IN ('urn:region:1', 'urn:nation:3', 'urn:nation:7')",
)
def construct_quads(spark, sf_dir):
    return construct.construct_quads(
        V.quads(spark, sf_dir, [NATION, CUSTOMER]),
        predicates=["urn:p:n_regionkey", "urn:p:c_nationkey"],
        objects=["urn:region:1", "urn:nation:3", "urn:nation:7"],
        graphs=[NATION, CUSTOMER],
        is_set=True,
    )


@query("graph_scope_named", Q + f"SELECT {C} FROM quads WHERE g IS NOT NULL AND p = '{RDF_TYPE}'")
def graph_scope_named(spark, sf_dir):
    return dataset.named_graphs(V.quads(spark, sf_dir)).where(dataset.matching(p=RDF_TYPE))


@query("graph_scope_default", Q + f"SELECT {C} FROM quads WHERE g IS NULL")
def graph_scope_default(spark, sf_dir):
    return dataset.default_graph(V.quads(spark, sf_dir))


@query(
    "dataset_clause",
    Q + f"SELECT DISTINCT CAST(NULL AS VARCHAR) AS g, {TRIPLE} FROM quads WHERE g IN ('{NATION}', '{SUPPLIER}') "
    f"UNION ALL SELECT {C} FROM quads WHERE g = '{CUSTOMER}'",
)
def dataset_clause(spark, sf_dir):
    return dataset.dataset_clause(V.quads(spark, sf_dir), [NATION, SUPPLIER], [CUSTOMER], is_set=True)


@query(
    "prebind",
    Q + "SELECT s AS c, o AS segment FROM quads WHERE g IS NOT NULL AND p = 'urn:p:c_mktsegment' "
    f"AND o = 'BUILDING' AND o_type = 'literal' AND o_datatype = '{XSD}string' AND o_lang IS NULL",
)
def prebind(spark, sf_dir):
    solutions = bgp.bgp_join(V.quads(spark, sf_dir), [("?c", "urn:p:c_mktsegment", "?segment", "?g")])
    bound = dataset.prebind(solutions, {"segment": literal("BUILDING")})
    return bound.select("c", "segment")


@query(
    "values_clause",
    Q + f"SELECT {C} FROM quads WHERE o IN (SELECT 'urn:nation:' || CAST(n_nationkey AS VARCHAR) "
    "FROM nation WHERE n_regionkey = 2) AND p IN ('urn:p:c_nationkey', 'urn:p:s_nationkey')",
)
def values_clause(spark, sf_dir):
    nations = V.table(spark, sf_dir, "nation").where("n_regionkey = 2").select(
        F.concat(F.lit("urn:nation:"), F.col("n_nationkey").cast("string"))
    )
    rows = dataset.restrict(V.quads(spark, sf_dir), "p", ["urn:p:c_nationkey", "urn:p:s_nationkey"])
    return dataset.restrict(rows, "o", nations)


@query(
    "select_vars",
    Q + "SELECT g AS graph, s AS a, p AS b, o AS c, o_type AS c_type, o_datatype AS c_datatype "
    f"FROM quads WHERE g = '{SUPPLIER}'",
)
def select_vars(spark, sf_dir):
    solutions = bgp.bgp_join(V.quads(spark, sf_dir), [("?a", "?b", "?c", "?graph")])
    kept = dataset.prebind(dataset.select_vars(solutions, ["graph", "a", "b", "c"]), {"graph": SUPPLIER})
    return kept.select("graph", "a", "b", "c", "c_type", "c_datatype")


@query(
    "has_value",
    Q + "SELECT count(*) AS n, count(o_datatype) AS with_datatype FROM quads",
)
def has_value(spark, sf_dir):
    return V.quads(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(dataset.has_value("o_datatype")).alias("with_datatype")
    )


@query(
    "paging",
    Q + f"SELECT DISTINCT {C} FROM (SELECT {C} FROM quads WHERE g IS NOT NULL ORDER BY {ORDER} LIMIT 300 OFFSET 500)",
)
def paging(spark, sf_dir):
    return construct.construct_quads(V.quads(spark, sf_dir), offset=500, limit=300, is_set=True)


@query(
    "paging_deep",
    Q + f"SELECT {C} FROM (SELECT {C} FROM quads ORDER BY {ORDER} OFFSET 1000)",
)
def paging_deep(spark, sf_dir):
    return page(V.quads(spark, sf_dir), offset=1000)


@query("get_graph", Q + f"SELECT {TRIPLE} FROM quads WHERE g = '{SUPPLIER}'")
def get_graph(spark, sf_dir):
    return dataset.get_graph(V.quads(spark, sf_dir, [SUPPLIER]), SUPPLIER)


@query("read_quads", Q + f"SELECT {C} FROM quads WHERE g = '{NATION}' OR g IS NULL")
def read_quads(spark, sf_dir):
    return V.quads(spark, sf_dir, [NATION, None])


# --- joins ------------------------------------------------------------------------------------


@query(
    "filter_construct",
    Q + f"SELECT DISTINCT {C} FROM quads q WHERE g IS NOT NULL AND p IN ('urn:p:c_name', 'urn:p:c_acctbal') "
    "AND EXISTS (SELECT 1 FROM quads a WHERE a.g = q.g AND a.s = q.s AND a.p = 'urn:p:c_mktsegment' "
    f"AND a.o = 'BUILDING' AND a.o_datatype = '{XSD}string') "
    "AND EXISTS (SELECT 1 FROM quads b WHERE b.g = q.g AND b.s = q.s AND b.p = 'urn:p:c_nationkey' "
    "AND b.o = 'urn:nation:3' AND b.o_type = 'uri')",
)
def filter_construct(spark, sf_dir):
    return construct.filter_construct(
        V.quads(spark, sf_dir),
        {"urn:p:c_mktsegment": literal("BUILDING"), "urn:p:c_nationkey": iri("urn:nation:3")},
        predicates=["urn:p:c_name", "urn:p:c_acctbal"],
        is_set=True,
    )


@query(
    "bgp_join",
    "SELECT 'urn:orders:' || CAST(o_orderkey AS VARCHAR) AS o, c_name AS name, n_name AS nation "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "WHERE n_regionkey = 2 AND o_orderstatus = 'F'",
)
def bgp_join(spark, sf_dir):
    solutions = bgp.bgp_join(
        V.quads(spark, sf_dir),
        [
            ("?o", "urn:p:o_custkey", "?c", "urn:g:orders"),
            ("?o", "urn:p:o_orderstatus", literal("F"), "urn:g:orders"),
            ("?c", "urn:p:c_name", "?name", CUSTOMER),
            ("?c", "urn:p:c_nationkey", "?n", CUSTOMER),
            ("?n", "urn:p:n_regionkey", "urn:region:2", NATION),
            ("?n", "urn:p:n_name", "?nation", NATION),
        ],
        statistics=V.quad_statistics(spark, sf_dir),
    )
    return solutions.select("o", "name", "nation")


@query(
    "bgp_star",
    "SELECT 'urn:part:' || CAST(p_partkey AS VARCHAR) AS x, p_name AS name, p_brand AS brand, "
    "CAST(p_size AS VARCHAR) AS size FROM part WHERE p_type = 'ECONOMY'",
)
def bgp_star(spark, sf_dir):
    solutions = bgp.bgp_join(
        V.quads(spark, sf_dir, ["urn:g:part"]),
        [
            ("?x", "urn:p:p_name", "?name", "?g"),
            ("?x", "urn:p:p_brand", "?brand", "?g"),
            ("?x", "urn:p:p_size", "?size", "?g"),
            ("?x", "urn:p:p_type", literal("ECONOMY"), "?g"),
        ],
        single_valued=["urn:p:p_name", "urn:p:p_brand", "urn:p:p_size", "urn:p:p_type"],
    )
    return solutions.select("x", "name", "brand", "size")


@query(
    "values_join",
    Q + f"SELECT DISTINCT {C} FROM quads WHERE g IS NOT NULL AND s IN "
    "(SELECT 'urn:customer:' || CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def values_join(spark, sf_dir):
    urgent = V.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("urn:customer:"), F.col("o_custkey").cast("string"))
    )
    return construct.construct_quads(V.quads(spark, sf_dir), subjects=urgent, is_set=True)


@query(
    "optional_var",
    "SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR) AS c, "
    "'urn:orders:' || CAST(o_orderkey AS VARCHAR) AS o FROM customer LEFT JOIN orders ON c_custkey = o_custkey",
)
def optional_var(spark, sf_dir):
    quads = V.quads(spark, sf_dir)
    customers = bgp.bgp_join(quads, [("?c", RDF_TYPE, "urn:type:customer", CUSTOMER)])
    solutions = bgp.optional(customers, quads, [("?o", "urn:p:o_custkey", "?c", "urn:g:orders")])
    return solutions.select("c", "o")


@query(
    "delete_anti",
    Q + f", doomed AS (SELECT * FROM quads WHERE p = 'urn:p:c_mktsegment' AND o = 'MACHINERY') "
    f"SELECT {C} FROM quads WHERE g IS DISTINCT FROM 'urn:g:orders' "
    "AND NOT (p = 'urn:p:c_mktsegment' AND o = 'MACHINERY' AND g IS NOT NULL)",
)
def delete_anti(spark, sf_dir):
    quads = V.quads(spark, sf_dir)
    doomed = quads.where((F.col("p") == "urn:p:c_mktsegment") & (F.col("o") == "MACHINERY"))
    rest = quads.where(~F.col("g").eqNullSafe(F.lit("urn:g:orders")))
    return update.delete_data(rest, doomed)


# --- sets, counts, order ----------------------------------------------------------------------


@query("model_distinct", Q + f"SELECT DISTINCT {C} FROM quads")
def model_distinct(spark, sf_dir):
    quads = V.quads(spark, sf_dir)
    return construct.statement_set(quads.unionByName(quads))


@query("graph_size", Q + "SELECT g, count(*) AS n FROM quads GROUP BY g")
def graph_size(spark, sf_dir):
    return dataset.graph_size(V.quads(spark, sf_dir))


@query("contexts", Q + "SELECT DISTINCT g FROM quads")
def contexts(spark, sf_dir):
    return dataset.contexts(V.quads(spark, sf_dir))


@query("predicates", Q + "SELECT DISTINCT p FROM quads")
def predicates(spark, sf_dir):
    return dataset.predicates(V.quads(spark, sf_dir))


@query(
    "limit",
    Q + f"SELECT {C} FROM quads WHERE g = '{CUSTOMER}' ORDER BY {ORDER} LIMIT 5",
)
def limit(spark, sf_dir):
    rows = V.quads(spark, sf_dir, [CUSTOMER]).where(F.col("g") == CUSTOMER)
    return dataset.top(rows, 5, QUAD_COLS)


# --- reification ------------------------------------------------------------------------------


@query(
    "reify",
    Q + ", parts AS (SELECT 'subject' AS part, s AS o, s_type AS o_type, NULL AS o_datatype, 4 AS n FROM quads "
    "WHERE g IS NOT NULL UNION ALL SELECT 'predicate', p, 'uri', NULL, 4 FROM quads WHERE g IS NOT NULL "
    "UNION ALL SELECT 'object', o, o_type, o_datatype, 4 FROM quads WHERE g IS NOT NULL "
    "UNION ALL SELECT 'graph', g, 'uri', NULL, 4 FROM quads WHERE g IS NOT NULL) "
    f"SELECT '{RDF}' || part AS p, o, o_type, o_datatype, count(*) AS n FROM parts GROUP BY ALL",
)
def reify(spark, sf_dir):
    # Nodes of a set of quads are all different: the quads are made a set once, so that their nodes need not be.
    rows = construct.reify(construct.statement_set(V.quads(spark, sf_dir)))
    return rows.groupBy("p", "o", "o_type", "o_datatype").agg(F.count("s").alias("n"))


@query("dereify", Q + f"SELECT DISTINCT {C} FROM quads WHERE g IS NOT NULL")
def dereify(spark, sf_dir):
    # The label of a node is a digest of its quad, so equal quads are one node already and move no second time.
    return construct.dereify(construct.reify(V.quads(spark, sf_dir)), is_set=True)


@query(
    "dereify_positional",
    "SELECT 'urn:g:orders' AS g, 'urn:orders:' || CAST(o_orderkey AS VARCHAR) AS s, 'uri' AS s_type, "
    "'urn:p:' || k.name AS p, CASE k.name WHEN 'o_orderstatus' THEN o_orderstatus ELSE o_orderpriority END AS o, "
    f"'literal' AS o_type, '{XSD}string' AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang, o_custkey AS doc "
    "FROM orders, (VALUES ('o_orderstatus'), ('o_orderpriority')) k(name)",
)
def dereify_positional(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    no = F.lit(None).cast("string")
    text = lambda v: F.struct(
        v.alias("o"), F.lit("literal").alias("o_type"), F.lit(XSD + "string").alias("o_datatype"), no.alias("o_lang")
    )
    node = lambda v: F.struct(
        v.alias("o"), F.lit("uri").alias("o_type"), no.alias("o_datatype"), no.alias("o_lang")
    )
    subject = F.concat(F.lit("urn:orders:"), F.col("o_orderkey").cast("string"))
    four = lambda name: [
        node(subject), node(F.lit(f"urn:p:{name}")), text(F.col(name)), node(F.lit("urn:g:orders"))
    ]
    # The lines of a document are its orders, eight lines each.
    lines = orders.select(
        F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("_k"),
        F.posexplode(F.array(*four("o_orderstatus"), *four("o_orderpriority"))).alias("_i", "_t"),
    ).select("doc", (F.col("_k") * 8 + F.col("_i")).alias("pos"), "_t.*")
    return construct.dereify_positional(lines, ["doc"], "pos", block_width=100_000).drop("window")


@query(
    "construct_template",
    "SELECT DISTINCT 'urn:g:derived' AS g, 'urn:customer:' || CAST(o_custkey AS VARCHAR) AS s, 'uri' AS s_type, "
    "k.p AS p, CASE k.p WHEN 'urn:p:placed' THEN 'urn:orders:' || CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END AS o, "
    "CASE k.p WHEN 'urn:p:placed' THEN 'uri' ELSE 'literal' END AS o_type, "
    f"CASE k.p WHEN 'urn:p:placed' THEN NULL ELSE '{XSD}string' END AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang "
    "FROM orders, (VALUES ('urn:p:placed'), ('urn:p:uses')) k(p)",
)
def construct_template(spark, sf_dir):
    solutions = bgp.bgp_join(
        V.quads(spark, sf_dir, ["urn:g:orders"]),
        [
            ("?o", "urn:p:o_custkey", "?c", "urn:g:orders"),
            ("?o", "urn:p:o_orderpriority", "?prio", "urn:g:orders"),
        ],
    )
    template = [("?c", "urn:p:placed", "?o"), ("?c", "urn:p:uses", "?prio"), ("?prio", "urn:p:never", "?c")]
    return construct.instantiate(solutions, template, "urn:g:derived")


# --- updates ----------------------------------------------------------------------------------

_PAYLOAD = f"SELECT DISTINCT {TRIPLE} FROM quads WHERE g = '{NATION}' OR g IS NULL"
_MOVED = f"SELECT '{SUPPLIER}' AS g, {TRIPLE} FROM payload"


def _payload(spark, sf_dir):
    return V.quads(spark, sf_dir, [NATION, None])


@query("load_graph", Q + f", payload AS ({_PAYLOAD}) {_MOVED}")
def load_graph(spark, sf_dir):
    return update.load_graph(_payload(spark, sf_dir), SUPPLIER)


@query("insert_model", Q + f", payload AS ({_PAYLOAD}) SELECT CAST(NULL AS VARCHAR) AS g, {TRIPLE} FROM payload")
def insert_model(spark, sf_dir):
    return update.insert_model(_payload(spark, sf_dir), None)


@query(
    "graph_merge",
    Q + f", payload AS ({_PAYLOAD}) SELECT {C} FROM quads UNION {_MOVED}",
)
def graph_merge(spark, sf_dir):
    return update.graph_merge(V.quads(spark, sf_dir), _payload(spark, sf_dir), SUPPLIER)


@query(
    "graph_replace",
    Q + f", payload AS ({_PAYLOAD}) SELECT {C} FROM quads WHERE g IS DISTINCT FROM '{SUPPLIER}' UNION ALL {_MOVED}",
)
def graph_replace(spark, sf_dir):
    return update.graph_replace(V.quads(spark, sf_dir), _payload(spark, sf_dir), SUPPLIER)


@query("graph_drop", Q + f"SELECT {C} FROM quads WHERE g IS NOT NULL")
def graph_drop(spark, sf_dir):
    return update.graph_drop(V.quads(spark, sf_dir), None)


@query("drop_silent", Q + f"SELECT {C} FROM quads WHERE g IS DISTINCT FROM '{CUSTOMER}'")
def drop_silent(spark, sf_dir):
    rest = update.graph_drop(V.quads(spark, sf_dir), "urn:g:not-there", silent=True)
    return update.graph_drop(rest, CUSTOMER, silent=False)


@query(
    "insert_data",
    Q + f"SELECT {C} FROM quads UNION SELECT 'urn:g:' || c_mktsegment, 'urn:customer:' || CAST(c_custkey AS VARCHAR), "
    f"'uri', '{RDF_TYPE}', 'urn:type:customer', 'uri', NULL, NULL FROM customer",
)
def insert_data(spark, sf_dir):
    uri, no = F.lit("uri"), F.lit(None).cast("string")
    data = V.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("urn:g:"), F.col("c_mktsegment")).alias("g"),
        F.concat(F.lit("urn:customer:"), F.col("c_custkey").cast("string")).alias("s"), uri.alias("s_type"),
        F.lit(RDF_TYPE).alias("p"), F.lit("urn:type:customer").alias("o"), uri.alias("o_type"),
        no.alias("o_datatype"), no.alias("o_lang"),
    )
    return update.insert_data(V.quads(spark, sf_dir), data)


@query(
    "delete_insert_where",
    Q + f", hit AS (SELECT s FROM quads WHERE g = '{CUSTOMER}' AND p = 'urn:p:c_mktsegment' AND o = 'BUILDING') "
    f"SELECT {C} FROM quads WHERE NOT coalesce(g = '{CUSTOMER}' AND p = 'urn:p:c_mktsegment' AND o = 'BUILDING', false) "
    f"UNION SELECT '{CUSTOMER}', s, 'uri', 'urn:p:c_mktsegment', 'CONSTRUCTION', 'literal', '{XSD}string', NULL FROM hit",
)
def delete_insert_where(spark, sf_dir):
    segment = "urn:p:c_mktsegment"
    return update.delete_insert_where(
        V.quads(spark, sf_dir),
        where=[("?c", segment, literal("BUILDING"))],
        delete=[("?c", segment, literal("BUILDING"))],
        insert=[("?c", segment, literal("CONSTRUCTION"))],
        graph=CUSTOMER,
    )


@query("delete_where", Q + f"SELECT {C} FROM quads WHERE g IS NOT NULL")
def delete_where(spark, sf_dir):
    return update.delete_where(V.quads(spark, sf_dir), ("?s", "?p", "?o"))


# --- graph log --------------------------------------------------------------------------------

_LOG = (
    f"WITH ops AS ({V.OPS_SQL}), payload AS ({V.PAYLOAD_SQL}), "
    "resets AS (SELECT g, max(seq) AS reset FROM ops WHERE op IN ('PUT', 'DELETE') GROUP BY g) "
)


@query(
    "graph_log_replay",
    _LOG + f"SELECT DISTINCT o.g AS g, {', '.join('p.' + c for c in TRIPLE_COLS)} FROM payload p JOIN ops o USING (seq) "
    "LEFT JOIN resets r ON o.g = r.g WHERE r.reset IS NULL OR p.seq >= r.reset",
)
def graph_log_replay(spark, sf_dir):
    return graph_log.graph_log_replay(V.ops(spark, sf_dir), V.payload(spark, sf_dir))


@query(
    "graph_log_outcomes",
    _LOG + ", traced AS (SELECT o.*, (SELECT arg_max(w.op, w.seq) FROM ops w WHERE w.g = o.g AND w.seq < o.seq AND w.op <> 'GET') AS prior, "
    "(SELECT max(w.seq) FROM ops w WHERE w.g = o.g AND w.seq <= o.seq AND w.op IN ('PUT', 'DELETE')) AS epoch FROM ops o), "
    "outcome AS (SELECT *, op IN ('PUT', 'POST') OR coalesce(prior <> 'DELETE', false) AS success FROM traced) "
    "SELECT seq, op, g, success, CAST(CASE WHEN NOT success THEN 404 WHEN op IN ('PUT', 'POST') AND NOT coalesce(prior <> 'DELETE', false) THEN 201 "
    "WHEN op = 'GET' THEN 200 ELSE 204 END AS INTEGER) AS status, "
    "(SELECT count(DISTINCT concat_ws('|', p.p, p.o)) FROM payload p JOIN ops w USING (seq) WHERE w.g = t.g AND p.seq <= t.seq "
    "AND p.seq >= coalesce(t.epoch, -1)) AS size_after FROM outcome t",
)
def graph_log_outcomes(spark, sf_dir):
    return graph_log.graph_log_outcomes(V.ops(spark, sf_dir), V.payload(spark, sf_dir))


@query(
    "count_window",
    "WITH n AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS v, "
    "row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS rn FROM events) "
    "SELECT user_id, CAST(floor(rn / 4) AS BIGINT) AS w, count(*) AS n, CAST(sum(v) AS BIGINT) AS total "
    "FROM n GROUP BY ALL",
)
def count_window(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.floor("value").alias("v")
    )
    placed = scans.count_windows(events, ["user_id"], "event_id", 4)
    return placed.groupBy("user_id", F.col("window").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")
    )


# --- reasoning --------------------------------------------------------------------------------

_SUB_CLASS, _SUB_PROPERTY = RDFS + "subClassOf", RDFS + "subPropertyOf"


@query(
    "rdfs_closure",
    f"WITH RECURSIVE h AS ({V.HIERARCHY_SQL}), "
    f"cls(sub, sup) AS (SELECT s, o FROM h WHERE p = '{_SUB_CLASS}' UNION "
    f"SELECT cls.sub, h.o FROM cls JOIN h ON cls.sup = h.s AND h.p = '{_SUB_CLASS}'), "
    f"prop(sub, sup) AS (SELECT s, o FROM h WHERE p = '{_SUB_PROPERTY}' UNION "
    f"SELECT prop.sub, h.o FROM prop JOIN h ON prop.sup = h.s AND h.p = '{_SUB_PROPERTY}'), "
    "stated AS (SELECT s, p, o FROM h UNION SELECT h.s, prop.sup, h.o FROM h JOIN prop ON h.p = prop.sub), "
    f"typed AS (SELECT s, o FROM stated WHERE p = '{RDF_TYPE}' UNION "
    f"SELECT x.s, d.o FROM stated x JOIN h d ON d.s = x.p AND d.p = '{RDFS}domain' UNION "
    f"SELECT x.o, d.o FROM stated x JOIN h d ON d.s = x.p AND d.p = '{RDFS}range'), "
    f"everything AS (SELECT * FROM stated UNION SELECT s, '{RDF_TYPE}', o FROM typed UNION "
    f"SELECT s, '{RDF_TYPE}', sup FROM typed JOIN cls ON typed.o = cls.sub UNION "
    f"SELECT sub, '{_SUB_CLASS}', sup FROM cls UNION SELECT sub, '{_SUB_PROPERTY}', sup FROM prop) "
    "SELECT 'urn:g:h' AS g, s, 'uri' AS s_type, p, o, 'uri' AS o_type, CAST(NULL AS VARCHAR) AS o_datatype, "
    "CAST(NULL AS VARCHAR) AS o_lang FROM everything",
)
def rdfs_closure(spark, sf_dir):
    return reasoning.rdfs_closure(V.hierarchy(spark, sf_dir))


@query(
    "construct_reasoning",
    "SELECT * FROM (" + ORACLES["rdfs_closure"] + f") WHERE p = '{RDF_TYPE}'",
)
def construct_reasoning(spark, sf_dir):
    """Types that are stated or entailed."""
    quads = V.hierarchy(spark, sf_dir)
    return construct.construct_quads(quads, predicates=[RDF_TYPE], reasoning=True)


# --- search -----------------------------------------------------------------------------------

_WORDS = ["hand", "éou", "ntea"]
_COUNTS = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(_WORDS))
_BM25 = " + ".join(
    f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len / avg))"
    for i in range(len(_WORDS))
)
SEARCH = (
    D + ", lits AS (SELECT DISTINCT o FROM docs WHERE o_type = 'literal'), "
    "cut AS (SELECT o, regexp_extract_all(lower(o), '[\\p{L}\\p{N}_]+') AS w FROM lits), "
    f"counted AS (SELECT o, len(w) AS len, {_COUNTS} FROM cut), "
    "stats AS (SELECT count(*) AS n, avg(len) AS avg, "
    + ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(_WORDS)))
    + " FROM counted), "
    f"scored AS (SELECT o, {_BM25} AS score FROM counted, stats WHERE tf0 > 0 OR tf1 > 0 OR tf2 > 0) "
)


@query(
    "topk_text",
    SEARCH + "SELECT o AS value, round(score, 6) AS score FROM scored ORDER BY round(score, 9) DESC, o LIMIT 10",
)
def topk_text(spark, sf_dir):
    hits = search.topk_text(V.document_quads(spark, sf_dir), " ".join(_WORDS), index=V.document_index(spark, sf_dir))
    return hits.select("value", F.round("score", 6).alias("score"))


@query(
    "search_construct",
    SEARCH + ", hits AS (SELECT o FROM scored ORDER BY round(score, 9) DESC, o LIMIT 25) "
    f"SELECT DISTINCT {C} FROM (SELECT {C} FROM docs WHERE p = 'urn:p:text' AND o IN (SELECT o FROM hits) "
    f"ORDER BY {ORDER} LIMIT 25)",
)
def search_construct(spark, sf_dir):
    return search.search_construct(
        V.document_quads(spark, sf_dir), " ".join(_WORDS), predicates=["urn:p:text"], limit=25, is_set=True,
        index=V.document_index(spark, sf_dir),
    )


@query(
    "search_join",
    SEARCH + ", hits AS (SELECT o FROM scored ORDER BY round(score, 9) DESC, o LIMIT 10) "
    f"SELECT DISTINCT {C} FROM docs WHERE o_type = 'literal' AND o IN (SELECT o FROM hits)",
)
def search_join(spark, sf_dir):
    return search.search_construct(V.document_quads(spark, sf_dir), " ".join(_WORDS), index=V.document_index(spark, sf_dir))
