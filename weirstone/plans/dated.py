"""The dated pipeline over the test tables, by month of the order date."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.canonical import scaled
from weirstone.functions.rundate import run_day as day_of
from weirstone.operators import dated, quality
from weirstone.plans.registry import query, table
from weirstone.session import fresh_path
from weirstone.sources import publish
from weirstone.sources.tables import read_partitioned

MIN_LINES = 20
# The month that runs a second time, and the month of each year that lands anew.
AGAIN, LATE = "199805", "05"


def _landed(spark, sf):
    month = F.date_format("o_orderdate", "yyyyMM").alias("pt")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", month)
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), scaled(F.col("l_extendedprice")).alias("cents")
    )
    lines = lines.join(orders.select("o_orderkey", "pt"), "o_orderkey")
    return dated.land(orders, fresh_path(spark, "ods-orders")), dated.land(lines, fresh_path(spark, "ods-lines"))


def _rollup(day):
    by_order = day.groupBy("o_orderpriority", "o_orderkey", "pt").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    return by_order.groupBy("o_orderpriority", "pt").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("n").alias("n_lines"), F.sum("cents").alias("cents")
    )


def _run(spark, sf):
    orders, lines = _landed(spark, sf)
    facts, mart, audit = (fresh_path(spark, n) for n in ("dwd-facts", "dws-months", "audit"))
    rows = read_partitioned(spark, lines.path, lines.schema).join(
        read_partitioned(spark, orders.path, orders.schema), ["pt", "o_orderkey"]
    )
    dated.run_days(rows, _rollup, facts, mart, audit, MIN_LINES)
    # one month runs again by itself: its partition is the same afterwards
    again = dated.day_facts(spark, lines, orders, ["o_orderkey"], AGAIN)
    dated.run_day(spark, again, _rollup, facts, mart, audit, AGAIN, MIN_LINES)
    return mart, audit


_FACTS = """SELECT strftime(o_orderdate, '%Y%m') AS pt, o_orderpriority, o_orderkey, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents
             FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
_MART = "o_orderpriority string, n_orders bigint, n_lines bigint, cents bigint, pt string"


@query(
    "daily_pipeline",
    f"""WITH f AS ({_FACTS}) SELECT o_orderpriority, pt, COUNT(DISTINCT o_orderkey) AS n_orders, COUNT(*) AS n_lines,
               CAST(SUM(cents) AS BIGINT) AS cents
        FROM f WHERE pt IN (SELECT pt FROM f GROUP BY pt HAVING COUNT(*) >= {MIN_LINES}) GROUP BY ALL""",
)
def daily_pipeline(spark, sf):
    mart, _ = _run(spark, sf)
    return spark.read.option("basePath", mart).schema(_MART).parquet(mart)


@query(
    "daily_pipeline_audit",
    f"""WITH f AS ({_FACTS}), n AS (SELECT pt, COUNT(*) AS n_rows FROM f GROUP BY pt),
             a AS (SELECT * FROM n UNION ALL SELECT '{AGAIN}', COALESCE((SELECT n_rows FROM n WHERE pt = '{AGAIN}'), 0))
        SELECT pt AS run_date, n_rows, {MIN_LINES}::BIGINT AS min_rows,
               CASE WHEN n_rows >= {MIN_LINES} THEN 'PASS' ELSE 'FAIL' END AS verdict FROM a""",
)
def daily_pipeline_audit(spark, sf):
    _, audit = _run(spark, sf)
    return spark.read.schema(dated.AUDIT).parquet(audit)


@query(
    "backfill_changed",
    f"""WITH o AS (SELECT strftime(o_orderdate, '%Y%m') AS pt, o_orderpriority,
                          CAST(ROUND(o_totalprice * 100) AS BIGINT) * CASE WHEN strftime(o_orderdate, '%m') = '{LATE}' THEN 2 ELSE 1 END AS cents
                   FROM orders)
        SELECT pt, o_orderpriority, COUNT(*) AS n_orders, CAST(SUM(cents) AS BIGINT) AS cents,
               CASE WHEN substr(pt, 5) = '{LATE}' THEN 2 ELSE 1 END::BIGINT AS run
        FROM o GROUP BY pt, o_orderpriority""",
)
def backfill_changed(spark, sf):
    # All months are computed in the first run.  Then some months land anew with other prices: the second
    # run computes these, the third finds nothing to do.
    month = F.date_format("o_orderdate", "yyyyMM").alias("pt")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", scaled(F.col("o_totalprice")).alias("cents"), month)
    source, mart, manifest = (fresh_path(spark, n) for n in ("ods-orders", "dws-backfill", "manifest"))

    def rollup(run):
        return lambda rows: rows.groupBy("pt", "o_orderpriority").agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("cents"), F.lit(run).cast("bigint").alias("run")
        )

    late = orders.where(F.endswith("pt", F.lit(LATE))).withColumn("cents", F.col("cents") * 2)
    for run, rows in ((1, orders), (2, late), (3, None)):
        if rows is not None:
            dated.land(rows, source)
        landed = read_partitioned(spark, source, orders.schema)
        dated.backfill(landed, rollup(run), mart, manifest, run)
    schema = "o_orderpriority string, n_orders bigint, cents bigint, run bigint, pt string"
    return spark.read.schema(schema).parquet(mart)


@query(
    "published_version",
    """SELECT o_orderkey, 1::BIGINT AS load FROM orders WHERE o_orderstatus = 'F'""",
)
def published_version(spark, sf):
    # The second load fails its check, the third breaks off before it: readers still have the first.
    orders = table(spark, sf, "orders")
    root = fresh_path(spark, "published")
    for load, rows in ((1, orders.where("o_orderstatus = 'F'")), (2, orders.where("o_orderkey < 0")), (3, None)):
        if rows is None:
            publish.write_version(orders.select("o_orderkey", F.lit(3).cast("bigint").alias("load")), root)
        else:
            loaded = rows.select("o_orderkey", F.lit(load).cast("bigint").alias("load"))
            publish.write_audit_publish(loaded, root, lambda df: quality.min_rows_gate(df, "load", 1))
    return publish.read_published(spark, root)


@query(
    "gate_failures",
    """SELECT strftime(ts, '%Y%m%d') AS pt, COUNT(*) AS n_rows, 330::BIGINT AS min_rows FROM events GROUP BY 1 HAVING COUNT(*) < 330""",
)
def gate_failures(spark, sf):
    events = table(spark, sf, "events").withColumn("pt", day_of(F.col("ts")))
    return dated.gate_failures(quality.min_rows_gate(events, "pt", 330), 330)
