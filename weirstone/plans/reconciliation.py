"""Quality gates, profiles and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.canonical import scaled
from weirstone.functions.rundate import run_day
from weirstone.operators import quality, reconcile
from weirstone.plans.registry import query, table

TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
)

# ---- SQL text of the canonical row hash and of the profile, per table ----
_COLUMNS = {
    "orders": [("o_orderkey", "i"), ("o_custkey", "i"), ("o_orderstatus", "s"), ("o_totalprice", "d"),
               ("o_orderdate", "t"), ("o_orderpriority", "s")],
    "customer": [("c_custkey", "i"), ("c_name", "s"), ("c_nationkey", "i"), ("c_acctbal", "d"), ("c_mktsegment", "s")],
    "lineitem": [("l_orderkey", "i"), ("l_partkey", "i"), ("l_suppkey", "i"), ("l_linenumber", "i"),
                 ("l_quantity", "d"), ("l_extendedprice", "d"), ("l_discount", "d"), ("l_tax", "d"),
                 ("l_returnflag", "s"), ("l_linestatus", "s"), ("l_shipdate", "t")],
}
_TEXT = {
    "i": "CAST({c} AS VARCHAR)",
    "d": "CAST(CAST(ROUND({c} * 100) AS BIGINT) AS VARCHAR)",
    "t": "CAST(epoch_us({c}) AS VARCHAR)",
    "s": "replace(replace(replace({c}, '\\', '\\\\'), '|', '\\p'), '~', '\\t')",
}


def _hash_sql(name: str) -> str:
    parts = ", ".join(f"COALESCE({_TEXT[k].format(c=c)}, '~')" for c, k in _COLUMNS[name])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 15)) AS BIGINT)"


def _value_sql(column: str, kind: str) -> str:
    return f"CAST(ROUND({column} * 100) AS BIGINT)" if kind == "d" else f"CAST({column} AS BIGINT)"


def _check_sql(name: str, source: str | None = None) -> str:
    numeric = [(c, k) for c, k in _COLUMNS[name] if k in "id"]
    entries = []
    for c, k in numeric:
        entries.append((f"sum_{c}", f"CAST(sum({_value_sql(c, k)}) AS VARCHAR)"))
        for f in ("min", "max"):
            entries.append((f"{f}_{c}", f"CAST({f}({c}) AS VARCHAR)"))
        if k == "d":
            entries.append((f"not_summed_{c}", "'0'"))
    text = " || ';' || ".join(f"'{label}=' || {value}" for label, value in sorted(entries))
    return (
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(SUM({_hash_sql(name)}) AS VARCHAR) AS checksum, "
        f"{text} AS aggregates, {len(entries)}::BIGINT AS n_aggregates FROM {source or name}"
    )


def _aggregate_text(col="aggregates"):
    pairs = F.transform(F.sort_array(F.map_entries(col)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(pairs, ";")


@query("table_checksum", f"SELECT COUNT(*) AS row_count, CAST(SUM({_hash_sql('orders')}) AS VARCHAR) AS checksum FROM orders")
def table_checksum(spark, sf):
    return reconcile.table_checksum(table(spark, sf, "orders"), digits=2)


@query(
    "numeric_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(SUM({_value_sql(c, k)}) AS VARCHAR) AS sum_value, "
        f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, 0::BIGINT AS n_not_summed FROM lineitem"
        for c, k in _COLUMNS["lineitem"] if k in "id"
    ),
)
def numeric_profile(spark, sf):
    return reconcile.numeric_profile(table(spark, sf, "lineitem"))


# Prices of some lines replaced by what ordinary sums choke on.
_ODD_PRICE = """CASE l_orderkey % 500 WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE WHEN 3 THEN 1e18::DOUBLE
                WHEN 4 THEN -1e300::DOUBLE ELSE l_extendedprice END"""


@query(
    "profile_extremes",
    f"""SELECT 'price' AS column_name,
               CAST(SUM(CASE WHEN abs(p) < 1e26 THEN CAST(ROUND(p * 100) AS HUGEINT) END) AS VARCHAR) AS sum_value,
               CAST(COUNT(*) FILTER (WHERE NOT abs(p) < 1e26) AS BIGINT) AS n_not_summed,
               MIN(p) = -1e300::DOUBLE AS low_kept, isnan(MAX(p)) AS nan_kept
        FROM (SELECT {_ODD_PRICE} AS p FROM lineitem)""",
)
def profile_extremes(spark, sf):
    price = F.expr(
        """CASE l_orderkey % 500 WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity') WHEN 3 THEN 1e18D
           WHEN 4 THEN -1e300D ELSE l_extendedprice END"""
    )
    profile = reconcile.numeric_profile(table(spark, sf, "lineitem").select(price.alias("price")))
    return profile.select(
        "column_name", "sum_value", "n_not_summed",
        (F.col("min_value").cast("double") == -1e300).alias("low_kept"),
        F.isnan(F.col("max_value").cast("double")).alias("nan_kept"),
    )


CHECKED = ("customer", "lineitem", "orders")
_CHECKS_SQL = " UNION ALL ".join(_check_sql(n) for n in CHECKED)


def _checks(spark, sf):
    return reconcile.check_tables({n: table(spark, sf, n) for n in CHECKED}, digits=2)


@query("table_checks", f"SELECT table_name, row_count, checksum, aggregates, row_count > 0 AS ok FROM ({_CHECKS_SQL})")
def table_checks(spark, sf):
    return _checks(spark, sf).withColumn("aggregates", _aggregate_text())


@query(
    "check_summary",
    f"""SELECT table_name, row_count, checksum, n_aggregates,
               CASE WHEN row_count > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_CHECKS_SQL})""",
)
def check_summary(spark, sf):
    return reconcile.check_summary(_checks(spark, sf))


@query(
    "check_verdict",
    f"""SELECT COUNT(*) AS n_checks, CAST(COUNT(*) FILTER (WHERE row_count = 0) AS BIGINT) AS n_failed, 'PASS' AS status
        FROM ({_CHECKS_SQL})""",
)
def check_verdict(spark, sf):
    return reconcile.check_verdict(_checks(spark, sf))


@query("lineitem_check", _check_sql("lineitem"))
def lineitem_check(spark, sf):
    """Headline job: count, checksum and profile of the largest table in one scan."""
    checked = reconcile.check_table(table(spark, sf, "lineitem"), "lineitem", digits=2).drop("ok")
    return checked.withColumns(
        {"n_aggregates": F.size("aggregates").cast("bigint"), "aggregates": _aggregate_text()}
    )


_PERTURBED = "(SELECT * REPLACE (CASE WHEN o_orderkey = 5 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders)"


@query(
    "parity_tables",
    f"""SELECT s.table_name, s.row_count AS source_rows, t.row_count AS target_rows, s.row_count = t.row_count AS count_ok,
               s.checksum = t.checksum AS checksum_ok, s.aggregates = t.aggregates AS aggregates_ok,
               s.row_count = t.row_count AND s.checksum = t.checksum AND s.aggregates = t.aggregates AS ok
        FROM ({_check_sql('orders')} UNION ALL {_check_sql('customer')}) s
        JOIN ({_check_sql('orders', _PERTURBED)} UNION ALL {_check_sql('customer')}) t ON s.table_name = t.table_name""",
)
def parity_tables(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    status = F.when(F.col("o_orderkey") == 5, "X").otherwise(F.col("o_orderstatus"))
    changed = orders.withColumn("o_orderstatus", status)
    return reconcile.compare_checks(
        reconcile.check_tables({"orders": orders, "customer": customer}, digits=2),
        reconcile.check_tables({"orders": changed, "customer": customer}, digits=2),
    )


@query(
    "reconcile_grouped",
    """SELECT a.o_orderpriority, a.n AS source_n, b.n AS target_n,
              CASE WHEN b.n IS NULL THEN 'source_only' WHEN a.n = b.n THEN 'match' ELSE 'diff' END AS status
       FROM (SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1) a
       LEFT JOIN (SELECT o_orderpriority, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
                  GROUP BY 1) b ON a.o_orderpriority = b.o_orderpriority""",
)
def reconcile_grouped(spark, sf):
    orders = table(spark, sf, "orders")
    n = F.count(F.lit(1)).alias("n")
    source = orders.groupBy("o_orderpriority").agg(n)
    target = orders.where("o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'").groupBy("o_orderpriority").agg(n)
    return reconcile.compare_keyed(source, target, ["o_orderpriority"], ["n"])


@query(
    "value_parity_sample",
    """WITH s AS (SELECT * FROM customer WHERE substr(md5(CAST(c_custkey AS VARCHAR)), 1, 1) < '4')
       SELECT 'c_mktsegment' AS column_name, CAST(COUNT(*) FILTER (WHERE c_nationkey = 3) AS BIGINT) AS mismatches, COUNT(*) AS compared,
              0::BIGINT AS source_only, 0::BIGINT AS target_only, 0::BIGINT AS duplicate_keys FROM s
       UNION ALL SELECT 'c_name', 0::BIGINT, COUNT(*), 0::BIGINT, 0::BIGINT, 0::BIGINT FROM s""",
)
def value_parity_sample(spark, sf):
    source = table(spark, sf, "customer")
    segment = F.when(F.col("c_nationkey") == 3, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    target = source.withColumn("c_mktsegment", segment)
    return reconcile.value_parity(source, target, "c_custkey", ["c_mktsegment", "c_name"], "4")


@query(
    "value_parity",
    """SELECT 'c_mktsegment' AS column_name,
              CAST(COUNT(*) FILTER (WHERE k % 10 BETWEEN 1 AND 7 AND c_nationkey = 3) AS BIGINT) AS mismatches,
              CAST(COUNT(*) FILTER (WHERE k % 10 BETWEEN 1 AND 7) AS BIGINT) AS compared,
              CAST(COUNT(*) FILTER (WHERE k % 10 = 8) AS BIGINT) AS source_only,
              CAST(COUNT(*) FILTER (WHERE k % 10 = 9) AS BIGINT) AS target_only,
              CAST(COUNT(*) FILTER (WHERE k % 10 = 0) AS BIGINT) AS duplicate_keys
       FROM (SELECT *, c_custkey AS k FROM customer)""",
)
def value_parity(spark, sf):
    # Keys that end in 8 are in the source only, in 9 in the target only, in 0 twice in the target.
    rows = table(spark, sf, "customer")
    last = F.col("c_custkey") % 10
    segment = F.when(F.col("c_nationkey") == 3, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    changed = rows.withColumn("c_mktsegment", segment)
    target = changed.where(last != 8).unionByName(changed.where(last == 0))
    return reconcile.value_parity(rows.where(last != 9), target, "c_custkey", ["c_mktsegment"])


@query(
    "stable_three_runs",
    """SELECT event_type, pt, n, spread, n_runs, n_runs = 3 AND spread <= 25 AS stable FROM (
         SELECT event_type, pt, n, MAX(n) OVER w - MIN(n) OVER w AS spread, COUNT(n) OVER w AS n_runs
         FROM (SELECT event_type, strftime(ts, '%Y%m%d') AS pt, COUNT(*) AS n FROM events GROUP BY 1, 2)
         WINDOW w AS (PARTITION BY event_type ORDER BY pt ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
)
def stable_three_runs(spark, sf):
    runs = table(spark, sf, "events").groupBy("event_type", run_day(F.col("ts")).alias("pt")).agg(F.count(F.lit(1)).alias("n"))
    return reconcile.stable_runs(runs, "pt", "n", 25, ["event_type"])


_SIZES = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES)


@query("row_counts", _SIZES)
def row_counts(spark, sf):
    return quality.row_counts({n: table(spark, sf, n) for n in TABLES})


@query(
    "tables_non_empty",
    f"""SELECT table_name, row_count, row_count > 0 AS ok, '' AS detail FROM (
          {_SIZES} UNION ALL SELECT 'orders_none', COUNT(*) FROM orders WHERE o_orderkey < 0)""",
)
def tables_non_empty(spark, sf):
    tables = {n: table(spark, sf, n) for n in TABLES}
    tables["orders_none"] = table(spark, sf, "orders").where("o_orderkey < 0")
    return quality.non_empty(tables)


@query("gate_verdict", f"SELECT COUNT(*) AS n_checks, 0::BIGINT AS n_failed, TRUE AS passed FROM ({_SIZES})")
def gate_verdict(spark, sf):
    return quality.verdict(quality.non_empty({n: table(spark, sf, n) for n in TABLES}))


@query(
    "assert_non_null",
    """SELECT 'customer' AS table_name, 'non_null' AS assertion, 'c_name' AS subject,
              CAST(COUNT(*) FILTER (WHERE c_name IS NULL) AS BIGINT) AS violations, TRUE AS ok FROM customer
       UNION ALL
       SELECT 'customer', 'non_null', 'good_segment', CAST(COUNT(*) FILTER (WHERE c_acctbal <= 0) AS BIGINT),
              COUNT(*) FILTER (WHERE c_acctbal <= 0) = 0 FROM customer""",
)
def assert_non_null(spark, sf):
    rows = table(spark, sf, "customer").withColumn("good_segment", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    return quality.assert_table(rows, "customer", ["c_name", "good_segment"])


@query(
    "assert_row_conditions",
    """SELECT 'lineitem' AS table_name, 'row_condition' AS assertion, 'quantity > 0' AS subject,
              CAST(COUNT(*) FILTER (WHERE NOT l_quantity > 0) AS BIGINT) AS violations,
              COUNT(*) FILTER (WHERE NOT l_quantity > 0) = 0 AS ok FROM lineitem
       UNION ALL
       SELECT 'lineitem', 'row_condition', 'discount < 0.1', CAST(COUNT(*) FILTER (WHERE NOT l_discount < 0.1) AS BIGINT),
              COUNT(*) FILTER (WHERE NOT l_discount < 0.1) = 0 FROM lineitem""",
)
def assert_row_conditions(spark, sf):
    return quality.assert_table(
        table(spark, sf, "lineitem"), "lineitem",
        conditions={"quantity > 0": F.col("l_quantity") > 0, "discount < 0.1": F.col("l_discount") < 0.1},
    )


def _day_gate(spark, sf):
    events = table(spark, sf, "events").withColumn("pt", run_day(F.col("ts")))
    return events, quality.min_rows_gate(events, "pt", 330)


_GATE_SQL = """SELECT strftime(ts, '%Y%m%d') AS pt, COUNT(*) AS n_rows,
              CASE WHEN COUNT(*) >= 330 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM events GROUP BY 1"""


@query("assert_min_rows", _GATE_SQL)
def assert_min_rows(spark, sf):
    return _day_gate(spark, sf)[1]


@query(
    "gated_load",
    f"""SELECT strftime(ts, '%Y%m%d') AS pt, COUNT(*) AS n, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM events WHERE strftime(ts, '%Y%m%d') IN (SELECT pt FROM ({_GATE_SQL}) WHERE verdict = 'PASS') GROUP BY 1""",
)
def gated_load(spark, sf):
    events, gate = _day_gate(spark, sf)
    return quality.passing(events, gate, "pt").groupBy("pt").agg(
        F.count(F.lit(1)).alias("n"), F.sum(scaled(F.col("value"))).alias("cents")
    )


@query(
    "assertion_report",
    """SELECT 'customer' AS table_name, 'non_null' AS assertion, 'c_name' AS subject,
              CAST(COUNT(*) FILTER (WHERE c_name IS NULL) AS BIGINT) AS violations,
              COUNT(*) FILTER (WHERE c_name IS NULL) = 0 AS ok FROM customer
       UNION ALL
       SELECT 'customer', 'row_condition', 'balance >= 0', CAST(COUNT(*) FILTER (WHERE NOT c_acctbal >= 0) AS BIGINT),
              COUNT(*) FILTER (WHERE NOT c_acctbal >= 0) = 0 FROM customer
       UNION ALL
       SELECT 'lineitem', 'row_condition', 'tax < 0.08', CAST(COUNT(*) FILTER (WHERE NOT l_tax < 0.08) AS BIGINT),
              COUNT(*) FILTER (WHERE NOT l_tax < 0.08) = 0 FROM lineitem""",
)
def assertion_report(spark, sf):
    return quality.assertion_report(
        [
            quality.assert_table(table(spark, sf, "customer"), "customer", ["c_name"], {"balance >= 0": F.col("c_acctbal") >= 0}),
            quality.assert_table(table(spark, sf, "lineitem"), "lineitem", conditions={"tax < 0.08": F.col("l_tax") < 0.08}),
        ]
    )


@query(
    "missing_tables",
    """SELECT 'weirstone_orders' AS table_name, COUNT(*) AS row_count, COUNT(*) > 0 AS ok, '' AS detail FROM orders
       UNION ALL SELECT 'weirstone_no_such_table', NULL, FALSE, 'table not found'""",
)
def missing_tables(spark, sf):
    # A name that is in no catalog is a failed row beside the counts of the others.
    table(spark, sf, "orders").createOrReplaceTempView("weirstone_orders")
    return quality.catalog_tables_non_empty(spark, ["weirstone_orders", "weirstone_no_such_table"])
