"""Joins, keyed de-duplication, merging and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.canonical import scaled
from weirstone.functions.rules import PLANNING_ROUTES, Rule, contains_any, first_match, lookup
from weirstone.operators import joins, keyed, reconcile, routing, setops
from weirstone.plans.registry import query, table
from weirstone.session import fresh_path
from weirstone.sources.documents import prefer_then_fallback as prefer


@query(
    "prefer_then_fallback",
    """SELECT c_custkey AS key, 'customer' AS origin FROM customer WHERE c_acctbal > 0
       UNION ALL
       SELECT DISTINCT o_custkey, 'orders' FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def prefer_then_fallback(spark, sf):
    known = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("key"), F.lit("customer").alias("origin")
    )
    seen = table(spark, sf, "orders").select(F.col("o_custkey").alias("key")).distinct()
    return prefer(known, seen.withColumn("origin", F.lit("orders")), "key")


@query(
    "override_merge",
    """SELECT d.doc_id,
              COALESCE(CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'good' END,
                       CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END) AS label,
              l.doc_id IS NOT NULL AND (l.toxic = 1 OR l.quality = 1) AS label_overridden
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def override_merge(spark, sf):
    label = F.when(F.col("n_chars") > 1000, "long").otherwise("short")
    auto = table(spark, sf, "documents").select("doc_id", label.alias("label"))
    given = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise(" ")
    overrides = table(spark, sf, "labels").select("doc_id", F.lit(0).alias("line"), given.alias("label"))
    return joins.override_merge(auto, overrides, "doc_id", ["label"], ["line"])


@query(
    "skip_filter",
    """SELECT d.doc_id, lang, COALESCE(l.toxic = 1, FALSE) AS skipped
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def skip_filter(spark, sf):
    mark = F.when(F.col("toxic") == 1, " True ").otherwise("")
    overrides = table(spark, sf, "labels").select("doc_id", mark.alias("skip"))
    return joins.split_skipped(table(spark, sf, "documents").select("doc_id", "lang"), overrides, "doc_id")


_ENTRIES = """SELECT s_name AS entry FROM supplier WHERE s_acctbal > 5000
       UNION ALL SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 5
       UNION ALL SELECT 'unknown_' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey = 7"""


def _selector(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        "s_name", F.col("s_suppkey").cast("string").alias("s_id"), "s_acctbal", "s_nationkey"
    )
    entries = (
        supplier.where("s_acctbal > 5000").select(F.col("s_name").alias("entry"))
        .unionByName(supplier.where("s_nationkey < 5").select(F.col("s_id").alias("entry")))
        .unionByName(supplier.where("s_nationkey = 7").select(F.concat(F.lit("unknown_"), "s_id").alias("entry")))
    )
    return supplier.select("s_name", "s_id"), entries


@query(
    "selector_keep",
    f"""SELECT s_name, CAST(s_suppkey AS VARCHAR) AS s_id FROM supplier
        WHERE s_name IN ({_ENTRIES}) OR CAST(s_suppkey AS VARCHAR) IN ({_ENTRIES})""",
)
def selector_keep(spark, sf):
    supplier, entries = _selector(spark, sf)
    return joins.keep_selected(supplier, entries, "entry", "s_name", "s_id")


@query(
    "selector_unmatched",
    f"""SELECT DISTINCT entry FROM ({_ENTRIES})
        WHERE entry NOT IN (SELECT s_name FROM supplier)
          AND entry NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
)
def selector_unmatched(spark, sf):
    supplier, entries = _selector(spark, sf)
    return joins.unmatched_entries(supplier, entries, "entry", "s_name", "s_id")


@query(
    "inputs_not_produced",
    """SELECT DISTINCT l_partkey AS part_key FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
)
def inputs_not_produced(spark, sf):
    reads = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part_key"))
    made = table(spark, sf, "part").where("p_size <= 25").select(F.col("p_partkey").alias("part_key"))
    return joins.read_not_produced(reads, made, "part_key")


@query(
    "absorb_or_flag",
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders
              WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') THEN 'absorbed' ELSE 'flagged' END AS status
       FROM customer""",
)
def absorb_or_flag(spark, sf):
    urgent = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return joins.absorb_or_flag(
        table(spark, sf, "customer").select("c_custkey"), urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"
    )


# Test rules: what an event type counts as.
EVENT_CLASSES = {"click": "engage", "view": "engage", "purchase": "revenue"}


@query(
    "lookup_with_default",
    """SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN 'engage'
              WHEN event_type = 'purchase' THEN 'revenue' ELSE 'review' END AS target
       FROM events""",
)
def lookup_with_default(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", lookup(F.col("event_type"), EVENT_CLASSES, "review").alias("target")
    )


@query(
    "rule_classify",
    """SELECT doc_id,
              CASE WHEN starts_with(text, 'The') THEN 'head'
                   WHEN contains(text, 'license') OR contains(text, '@') OR contains(text, 'http') THEN 'heavy'
                   WHEN n_chars < 200 THEN 'light' ELSE 'review' END AS target
       FROM documents""",
)
def rule_classify(spark, sf):
    text = F.col("text")
    rules = [
        Rule(F.startswith(text, F.lit("The")), "head"),
        Rule(contains_any(text, ["license", "@", "http"]), "heavy"),
        Rule(F.col("n_chars") < 200, "light"),
    ]
    target, _ = first_match(rules, Rule(F.lit(True), "review"))
    return table(spark, sf, "documents").select("doc_id", target.alias("target"))


@query(
    "edges_known",
    """SELECT p_partkey AS node, (p_partkey - 1) // 2 AS upstream FROM part
       WHERE p_partkey > 0 AND p_size <= 25
         AND (p_partkey - 1) // 2 IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
)
def edges_known(spark, sf):
    part = table(spark, sf, "part")
    edges = part.where("p_partkey > 0").selectExpr("p_partkey AS node", "(p_partkey - 1) DIV 2 AS upstream")
    return joins.known_edges(edges, part.where("p_size <= 25"), "node", "upstream", "p_partkey")


@query(
    "first_writer",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)
       WHERE n = 1""",
)
def first_writer(spark, sf):
    return keyed.first_per_key(
        table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
        ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"],
    )


@query(
    "duplicate_writers",
    """SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS winner_l_partkey, COUNT(*) AS n_rows, COUNT(*) - 1 AS n_losers
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def duplicate_writers(spark, sf):
    return keyed.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query(
    "later_writers",
    """SELECT o_custkey, o_orderkey, first_key AS winner_o_orderkey
       FROM (SELECT *, MIN(o_orderkey) OVER (PARTITION BY o_custkey) AS first_key FROM orders)
       WHERE o_orderkey <> first_key""",
)
def later_writers(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return keyed.later_writers(rows, ["o_custkey"], ["o_orderkey"])


@query(
    "dedupe_keep_null",
    """SELECT doc_id, source FROM (
         SELECT doc_id, source, key, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS n
         FROM (SELECT doc_id, source, nullif(source, 'src0') || md5(text) AS key FROM documents))
       WHERE key IS NULL OR n = 1""",
)
def dedupe_keep_null(spark, sf):
    key = F.concat(F.nullif(F.col("source"), F.lit("src0")), F.md5("text"))
    docs = table(spark, sf, "documents").select("doc_id", "source", key.alias("key"))
    return keyed.dedupe_keep_null(docs, "key", ["doc_id"], ["doc_id", "source"])


@query(
    "last_row_wins",
    """SELECT user_id, event_id, event_type
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
       WHERE n = 1""",
)
def last_row_wins(spark, sf):
    rows = keyed.last_per_key(
        table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["user_id", "ts", "event_id", "event_type"]
    )
    return rows.select("user_id", "event_id", "event_type")


@query(
    "merge_priority",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment || '_B' ELSE c_mktsegment END AS segment
       FROM customer WHERE c_nationkey < 15 OR c_acctbal > 0""",
)
def merge_priority(spark, sf):
    customer = table(spark, sf, "customer")
    first = customer.where("c_nationkey < 15").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    second = customer.where("c_acctbal > 0").select(
        "c_custkey", F.concat("c_mktsegment", F.lit("_B")).alias("segment")
    )
    return keyed.merge_priority([first, second], "c_custkey")


@query(
    "first_non_blank",
    """SELECT conv_id, arg_min(text, turn) FILTER (WHERE role <> 'system' AND trim(text) <> '') AS first_text
       FROM conversations GROUP BY conv_id""",
)
def first_non_blank(spark, sf):
    said = F.when(F.col("role") != "system", F.col("text"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", said.alias("said"))
    return keyed.first_non_blank(rows, ["conv_id"], ["turn"], "said", "first_text")


@query(
    "first_of_class",
    """SELECT user_id, COALESCE(CAST(MIN(event_id) FILTER (WHERE event_type = 'purchase') AS VARCHAR), 'none') AS first_purchase
       FROM events GROUP BY user_id""",
)
def first_of_class(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("event_id").cast("string").alias("name"))
    return keyed.first_of_class(
        rows, ["user_id"], ["event_id"], F.col("event_type") == "purchase", "name", "first_purchase", "none"
    )


@query("pending_items", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'")
def pending_items(spark, sf):
    orders = table(spark, sf, "orders")
    stored = orders.where("o_orderstatus = 'F'")
    return keyed.pending(orders.select("o_orderkey", "o_custkey"), stored, ["o_orderkey"])


@query(
    "insert_ignore",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name ELSE 'new_' || c_name END AS c_name FROM customer""",
)
def insert_ignore(spark, sf):
    # Stored: customers with a balance.  The batch has every customer, each of them twice.
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    stored = customer.where("c_acctbal > 0").select("c_custkey", "c_name")
    batch = customer.select("c_custkey", F.concat(F.lit("new_"), "c_name").alias("c_name"), F.lit(0).alias("line")).unionByName(
        customer.select("c_custkey", F.lit("late").alias("c_name"), F.lit(1).alias("line"))
    )
    fresh = keyed.insert_ignore(stored, batch, ["c_custkey"], ["line"])
    return stored.unionByName(fresh.select("c_custkey", "c_name"))


@query(
    "complete_groups",
    """SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_expected,
              COUNT(DISTINCT CASE WHEN l_linenumber <= 5 THEN l_linenumber END) AS n_stored
       FROM lineitem GROUP BY l_orderkey HAVING n_expected = n_stored""",
)
def complete_groups(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return keyed.complete_groups(lines, lines.where("l_linenumber <= 5"), "l_orderkey", ["l_linenumber"])


@query(
    "output_parity",
    """WITH s AS (SELECT DISTINCT c_nationkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey
                  WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
            g AS (SELECT DISTINCT c_nationkey, c_custkey FROM customer WHERE c_acctbal > 0)
       SELECT COALESCE(s.c_nationkey, g.c_nationkey) AS nation,
              CAST(COUNT(*) FILTER (WHERE s.c_custkey IS NOT NULL AND g.c_custkey IS NOT NULL) AS BIGINT) AS n_common,
              CAST(COUNT(*) FILTER (WHERE g.c_custkey IS NULL) AS BIGINT) AS n_missing,
              CAST(COUNT(*) FILTER (WHERE s.c_custkey IS NULL) AS BIGINT) AS n_extra
       FROM s FULL JOIN g ON s.c_custkey = g.c_custkey GROUP BY 1""",
)
def output_parity(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    urgent = (
        table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
        .select(F.col("o_custkey").alias("c_custkey")).distinct()
    )
    source = customer.join(urgent, "c_custkey", "left_semi")
    return setops.missing_and_extra_counts(source, customer.where("c_acctbal > 0"), "nation", ["c_custkey"])


@query(
    "output_parity_keys",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'extra' ELSE 'missing' END AS kind FROM customer
       WHERE (c_acctbal > 0) <> (c_custkey IN (SELECT o_custkey FROM orders
              WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'))""",
)
def output_parity_keys(spark, sf):
    source = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    built = table(spark, sf, "customer").where("c_acctbal > 0")
    return setops.missing_and_extra(source.select(F.col("o_custkey").alias("c_custkey")), built, ["c_custkey"])


@query(
    "union_detectors",
    """SELECT doc_id FROM documents WHERE contains(text, '@') UNION SELECT doc_id FROM labels WHERE toxic = 1
       UNION SELECT doc_id FROM documents WHERE lang = 'de'""",
)
def union_detectors(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return setops.any_detector(
        [docs.where(F.contains("text", F.lit("@"))), labels.where("toxic = 1"), docs.where("lang = 'de'")], "doc_id"
    )


@query(
    "intermediate_entities",
    "SELECT o_custkey AS cust_key FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0",
)
def intermediate_entities(spark, sf):
    read = table(spark, sf, "orders").select(F.col("o_custkey").alias("cust_key"))
    made = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("cust_key"))
    return setops.common(read, made, ["cust_key"])


@query(
    "rowdiff",
    """SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents, 'source_only' AS side, 1::BIGINT AS copies
       FROM orders WHERE o_orderkey IN (5, 7)
       UNION ALL
       SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) + 100, 'target_only', 1::BIGINT
       FROM orders WHERE o_orderkey = 7""",
)
def rowdiff(spark, sf):
    source = table(spark, sf, "orders").select("o_orderkey", "o_custkey", scaled(F.col("o_totalprice")).alias("cents"))
    changed = F.when(F.col("o_orderkey") == 7, F.col("cents") + 100).otherwise(F.col("cents"))
    target = source.where("o_orderkey <> 5").withColumn("cents", changed)
    return setops.row_difference(source, target)


@query(
    "parity_drilldown",
    """SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents, 'source_only' AS side, 1::BIGINT AS copies
       FROM orders WHERE o_orderkey IN (5, 7)
       UNION ALL
       SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) + 100, 'target_only', 1::BIGINT
       FROM orders WHERE o_orderkey = 7""",
)
def parity_drilldown(spark, sf):
    source = table(spark, sf, "orders").select("o_orderkey", "o_custkey", scaled(F.col("o_totalprice")).alias("cents"))
    changed = F.when(F.col("o_orderkey") == 7, F.col("cents") + 100).otherwise(F.col("cents"))
    target = source.where("o_orderkey <> 5").withColumn("cents", changed)
    paths = [fresh_path(spark, n) for n in ("parity-source", "parity-target")]
    for side, path in zip((source, target), paths):
        schema = reconcile.land_by_key(side, path, ["o_orderkey"], 16)
    return reconcile.drilldown(spark, *paths, schema, ["o_orderkey"])


# A routing table as rows: of all rules that hold, the one of the least priority counts.
_RULE_ROWS = """VALUES (1, NULL, 'head', 'The', 'head'), (2, NULL, 'holds', 'license', 'heavy'), (2, NULL, 'holds', '@', 'heavy'),
    (2, NULL, 'holds', 'http', 'heavy'), (3, 'short', NULL, NULL, 'light'), (9, NULL, NULL, NULL, 'review')"""


@query(
    "rule_table_classify",
    """SELECT doc_id,
              CASE WHEN starts_with(text, 'The') THEN 'head'
                   WHEN contains(text, 'license') OR contains(text, '@') OR contains(text, 'http') THEN 'heavy'
                   WHEN n_chars < 200 THEN 'light' ELSE 'review' END AS target
       FROM documents""",
)
def rule_table_classify(spark, sf):
    rules = spark.sql(f"SELECT * FROM {_RULE_ROWS} AS t(priority, command, test, marker, target)")
    rules = rules.withColumn("reason", F.concat_ws(" ", "test", "marker"))
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.when(F.col("n_chars") < 200, "short").otherwise("long").alias("command")
    )
    return routing.route(docs, rules, "command", "text").select("doc_id", "target")


@query(
    "routing_table_gaps",
    """SELECT command, CASE command WHEN 'ODPS_SQL' THEN 'Dataform .sqlx' WHEN 'VIRTUAL' THEN 'EmptyOperator' WHEN 'DIDE_SHELL' THEN 'TRIAGE'
              END AS target, COUNT(*) AS n FROM (
         SELECT CASE WHEN role = 'user' THEN 'ODPS_SQL' WHEN role = 'assistant' AND turn % 4 = 3 THEN 'DIDE_SHELL'
                     WHEN role = 'assistant' THEN 'PYODPS_3' ELSE 'VIRTUAL' END AS command FROM conversations) GROUP BY ALL""",
)
def routing_table_gaps(spark, sf):
    # The planning table as rows; a command that no rule names has no target.
    pairs = [(1, command, None, None, target, reason) for command, (target, reason) in PLANNING_ROUTES.items()]
    rules = spark.createDataFrame(pairs, "priority int, command string, test string, marker string, target string, reason string")
    command = F.expr(
        """CASE WHEN role = 'user' THEN 'ODPS_SQL' WHEN role = 'assistant' AND turn % 4 = 3 THEN 'DIDE_SHELL'
           WHEN role = 'assistant' THEN 'PYODPS_3' ELSE 'VIRTUAL' END"""
    )
    nodes = table(spark, sf, "conversations").select(command.alias("command"), "text")
    return routing.route(nodes, rules, "command", "text").groupBy("command", "target").agg(F.count(F.lit(1)).alias("n"))
