"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.rundate import run_day
from weirstone.plans.registry import query, table
from weirstone.session import fresh_path
from weirstone.sources import delimited, tables

CUSTOMER_TEXT = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


@query(
    "scan_delimited",
    """SELECT c_custkey, c_name, c_nationkey, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS acctbal_cents,
              c_mktsegment
       FROM customer""",
)
def scan_delimited(spark, sf):
    path = fresh_path(spark, "delimited")
    table(spark, sf, "customer").write.option("sep", ";").csv(path)
    rows = delimited.scan_delimited(spark, path, CUSTOMER_TEXT)
    return rows.select(
        "c_custkey", "c_name", "c_nationkey",
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("acctbal_cents"), "c_mktsegment",
    )


@query(
    "quarantine_counts",
    """SELECT c_custkey % 10 >= 3 AS good, COUNT(*) AS n,
              CAST(SUM(CASE WHEN c_custkey % 10 >= 3 THEN c_custkey END) AS BIGINT) AS key_sum
       FROM customer GROUP BY 1""",
)
def quarantine_counts(spark, sf):
    # One key in ten has too few fields, one too many, one a key that is no number.
    path = fresh_path(spark, "quarantine")
    kind = F.col("c_custkey") % 10
    whole = F.concat_ws(";", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    line = (
        F.when(kind == 0, F.concat_ws(";", "c_custkey", "c_name"))
        .when(kind == 1, F.concat(whole, F.lit(";extra")))
        .when(kind == 2, F.concat(F.lit("x"), whole))
        .otherwise(whole)
    )
    lines = table(spark, sf, "customer").select(line.alias("value"))
    # blank lines in between are no rows
    blank = lines.where(kind == 5).select(F.lit(" ").alias("value"))
    lines.unionByName(blank).write.text(path)
    good, bad = delimited.scan_with_quarantine(spark, path, CUSTOMER_TEXT)
    counted = good.agg(
        F.lit(True).alias("good"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("key_sum")
    )
    rejected = bad.agg(
        F.lit(False).alias("good"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("key_sum")
    )
    return counted.unionByName(rejected)


@query(
    "standardise_source",
    """SELECT o_orderkey AS order_key, o_custkey AS cust_key,
              replace(o_orderpriority, '"', '') AS priority,
              CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS finished
       FROM orders""",
)
def standardise_source(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order.key"),
        F.col("o_custkey").alias("cust.key"),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('"')).alias("priority"),
        F.col("o_orderstatus").alias("finished"),
    )
    return delimited.standardise(
        raw, {"order.key": "order_key", "cust.key": "cust_key"}, ["priority"], {"finished": "F"}
    )


def _events_by_day(spark, sf):
    return table(spark, sf, "events").withColumn("pt", run_day(F.col("ts")))


@query(
    "partition_read",
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS pt FROM events
       WHERE strftime(ts, '%Y%m%d') = '20240110'""",
)
def partition_read(spark, sf):
    path = fresh_path(spark, "events-by-day")
    events = _events_by_day(spark, sf)
    tables.overwrite_partitions(events, path)
    rows = tables.read_partitioned(spark, path, events.schema, "pt", "20240110")
    return rows.select("event_id", "user_id", "event_type", "pt")


@query(
    "override_scan",
    """SELECT CAST(doc_id AS VARCHAR) AS node_id,
              CASE WHEN toxic = 1 THEN 'TRIAGE' END AS gcp_target,
              CASE WHEN quality = 1 THEN 'good' || chr(10) || '"note", kept' END AS review_notes
       FROM labels WHERE doc_id % 7 <> 0""",
)
def override_scan(spark, sf):
    path = fresh_path(spark, "overrides")
    cells = {
        "node_id": F.when(F.col("doc_id") % 7 == 0, F.lit(" ")).otherwise(F.col("doc_id").cast("string")),
        "gcp_target": F.when(F.col("toxic") == 1, F.lit(" TRIAGE ")).otherwise(F.lit("  ")),
        "review_notes": F.when(F.col("quality") == 1, F.lit('good\n"note", kept')).otherwise(F.lit("")),
    }
    # the columns of the file stand in another order than usual
    names = tuple(reversed(delimited.MATRIX_FIELDS))
    columns = [cells.get(c, F.lit("")).alias(c) for c in names]
    tables.write_csv(table(spark, sf, "labels").select(*columns), path, names)
    return delimited.scan_overrides(spark, path).select("node_id", "gcp_target", "review_notes")


@query(
    "sink_overwrite",
    """SELECT c_mktsegment, COUNT(c_name) AS num FROM customer
       WHERE c_acctbal > 0 AND c_nationkey < 10 GROUP BY 1""",
)
def sink_overwrite(spark, sf):
    from weirstone.plans.layers import mart_segment_count

    path = fresh_path(spark, "mart")
    mart = mart_segment_count(spark, sf)
    tables.overwrite_table(mart.withColumn("num", F.col("num") + 1), path)
    tables.overwrite_table(mart, path)
    return spark.read.schema(mart.schema).parquet(path)


@query(
    "sink_partition_overwrite",
    """SELECT strftime(ts, '%Y%m%d') AS pt, COUNT(*) AS n,
              CAST(SUM(CASE WHEN strftime(ts, '%Y%m%d') = '20240105' THEN -event_id ELSE event_id END) AS BIGINT) AS id_sum
       FROM events GROUP BY 1""",
)
def sink_partition_overwrite(spark, sf):
    # Load all days, then one day again with changed rows, twice.
    path = fresh_path(spark, "daily")
    events = _events_by_day(spark, sf).select("event_id", "user_id", "pt")
    tables.overwrite_partitions(events, path)
    again = events.where(F.col("pt") == "20240105").withColumn("event_id", -F.col("event_id"))
    for _ in range(2):
        tables.overwrite_partitions(again, path)
    rows = tables.read_partitioned(spark, path, events.schema)
    return rows.groupBy("pt").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


@query("sink_append", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def sink_append(spark, sf):
    path = fresh_path(spark, "append")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.append_table(orders.where("o_orderstatus = 'F'"), path)
    tables.append_table(orders.where("o_orderstatus <> 'F'"), path)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "audit_log",
    """SELECT 'orders_load' AS workflow, '20240109' AS bizdate, 'SUCCESS' AS status,
              COUNT(*) AS rows_written, TRUE AS has_time
       FROM orders WHERE o_orderstatus = 'F'""",
)
def audit_log(spark, sf):
    path, log = fresh_path(spark, "audited"), fresh_path(spark, "audit-log")
    finished = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    tables.write_with_audit(finished, path, log, "orders_load", "20240109")
    rows = spark.read.schema(tables.AUDIT_SCHEMA).parquet(log)
    return rows.select(
        "workflow", "bizdate", "status", "rows_written", F.col("completed_at").isNotNull().alias("has_time")
    )


@query("sink_csv_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def sink_csv_roundtrip(spark, sf):
    path = fresh_path(spark, "csv")
    nation = table(spark, sf, "nation")
    columns = ["n_regionkey", "n_name", "n_nationkey"]
    tables.write_csv(nation, path, columns)
    rows = delimited.scan_delimited(spark, path, nation.select(*columns).schema, sep=",", header=True)
    return rows.select("n_nationkey", "n_name", "n_regionkey")
