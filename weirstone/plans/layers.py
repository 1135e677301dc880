"""Layered loads: source, facts, daily aggregate, mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.canonical import scaled
from weirstone.functions.rundate import bizdate
from weirstone.operators import joins, layers, ordering, reconcile
from weirstone.plans.registry import query, table
from weirstone.session import materialise


def _mart_filter():
    return (F.col("c_acctbal") > 0) & (F.col("c_nationkey") < 10)


@query(
    "ods_orders",
    """SELECT o_orderkey, o_custkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS total_cents,
              CAST(o_orderdate AS DATE) AS order_date,
              strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS pt
       FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def ods_orders(spark, sf):
    rows = layers.load_source(
        table(spark, sf, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        "o_orderpriority = :priority",
        {"priority": "1-URGENT"},
    )
    return rows.select(
        "o_orderkey", "o_custkey", scaled(F.col("o_totalprice")).alias("total_cents"),
        F.to_date("o_orderdate").alias("order_date"), bizdate(F.col("o_orderdate")).alias("pt"),
    )


@query("ods_customers", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0")
def ods_customers(spark, sf):
    return layers.load_source(
        table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey"], "c_acctbal > :floor", {"floor": 0.0}
    )


@query(
    "filter_name_contains",
    "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'widget')",
)
def filter_name_contains(spark, sf):
    return table(spark, sf, "part").where(F.contains("p_name", F.lit("widget"))).select("p_partkey", "p_name")


def facts(spark, sf):
    """Order lines of finished orders with customer and country."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    # Small sides first: only orders and lines meet in a large join.
    heads = layers.join_facts(orders, [(customer, "o_custkey", "c_custkey"), (nation, "c_nationkey", "n_nationkey")])
    return layers.join_facts(heads, [(lines, "o_orderkey", "l_orderkey")]).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        scaled(F.col("l_quantity") * F.col("l_extendedprice")).alias("line_total"),
        "country",
        F.to_date("o_orderdate").alias("order_date"),
    )


FACTS_SQL = """SELECT o_orderkey AS order_id, o_custkey AS user_id, c_name AS user_name, l_partkey AS product_id,
              l_linenumber AS line_number,
              CAST(ROUND(l_quantity * l_extendedprice * 100) AS BIGINT) AS line_total,
              n_name AS country, CAST(o_orderdate AS DATE) AS order_date
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderstatus = 'F'"""


@query("dwd_order_facts", FACTS_SQL)
def dwd_order_facts(spark, sf):
    return facts(spark, sf)


@query(
    "dws_agg_daily",
    f"""SELECT country, order_date, COUNT(DISTINCT user_id) AS unique_buyers,
               COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT product_id) AS unique_products,
               CAST(SUM(line_total) AS BIGINT) AS total_revenue
        FROM ({FACTS_SQL}) GROUP BY country, order_date""",
)
def dws_agg_daily(spark, sf):
    # an order has one buyer, so buyers are counted over orders and orders over lines
    return layers.chain_rollup(
        facts(spark, sf),
        ["country", "order_date"],
        [("total_orders", "order_id"), ("unique_buyers", "user_id")],
        {"unique_products": "product_id"},
        {"total_revenue": F.col("line_total")},
    )


# Relative error that the merged sketches must stay within: five standard errors of 2 ** 12 registers.
SKETCH_ERROR = 0.065


@query(
    "monthly_sketches",
    """SELECT n_name AS country, strftime(o_orderdate, '%Y%m') AS month, COUNT(DISTINCT o_custkey) AS buyers,
              COUNT(DISTINCT l_partkey) AS products, TRUE AS buyers_near, TRUE AS products_near
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def monthly_sketches(spark, sf):
    # days are sketched once and stored; months are unions of their days, held against the exact counts
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(homes, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select("country", "day", "o_orderkey", "o_custkey", "l_partkey")
    month = F.date_format("day", "yyyyMM").alias("month")
    days = materialise(layers.daily_sketches(rows, ["country", "day"], {"buyers": "o_custkey", "products": "l_partkey"}), "sketches")
    near = layers.merged_counts(days.withColumn("month", month), ["country", "month"], ["buyers", "products"])
    exact = layers.chain_rollup(
        rows.withColumn("month", month), ["country", "month"], [("orders", "o_orderkey"), ("buyers", "o_custkey")],
        {"products": "l_partkey"}, {},
    )
    both = exact.alias("e").join(near.alias("n"), ["country", "month"])

    def close(name):
        return (F.abs(F.col(f"e.{name}") - F.col(f"n.{name}")) <= F.greatest(F.lit(1), F.col(f"e.{name}") * SKETCH_ERROR)).alias(f"{name}_near")

    return both.select("country", "month", "e.buyers", "e.products", close("buyers"), close("products"))


MART_SQL = """SELECT c_mktsegment, COUNT(c_name) AS num FROM customer
       WHERE c_acctbal > 0 AND c_nationkey < 10 GROUP BY c_mktsegment"""


@query("mart_segment_count", MART_SQL)
def mart_segment_count(spark, sf):
    return layers.segment_count(table(spark, sf, "customer"), _mart_filter(), "c_mktsegment", "c_name")


@query("mart_sorted", f"SELECT *, row_number() OVER (ORDER BY num DESC, c_mktsegment) AS pos FROM ({MART_SQL})")
def mart_sorted(spark, sf):
    mart = mart_segment_count(spark, sf)
    return ordering.global_rank(mart, [F.col("num").desc(), F.col("c_mktsegment")], unique=True).orderBy("pos")


@query(
    "control_total",
    f"""SELECT (SELECT CAST(SUM(num) AS BIGINT) FROM ({MART_SQL})) AS mart_total,
               (SELECT COUNT(*) FROM customer WHERE c_acctbal > 0 AND c_nationkey < 10) AS source_rows,
               TRUE AS ok""",
)
def control_total(spark, sf):
    rows = table(spark, sf, "customer").where(_mart_filter())
    return reconcile.control_total(mart_segment_count(spark, sf), "num", rows)


@query(
    "broadcast_join",
    """SELECT n_name AS country, COUNT(*) AS n_orders, CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def broadcast_join(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), scaled(F.col("o_totalprice")).alias("cents"))
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    joined = joins.map_side_join(joins.map_side_join(orders, customer, ["c_custkey"]), nation, ["n_nationkey"])
    return joined.groupBy("country").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("cents").alias("total_cents"))


@query(
    "conditional_count",
    """SELECT l_returnflag, CAST(COUNT(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS n_discounted,
              CAST(COUNT(*) FILTER (WHERE l_tax = 0) AS BIGINT) AS n_untaxed
       FROM lineitem GROUP BY 1""",
)
def conditional_count(spark, sf):
    return layers.conditional_counts(
        table(spark, sf, "lineitem"), "l_returnflag",
        {"n_discounted": F.col("l_discount") > 0.05, "n_untaxed": F.col("l_tax") == 0},
    )


@query("class_counts", "SELECT event_type, COUNT(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def class_counts(spark, sf):
    return layers.class_counts(table(spark, sf, "events"), "event_type", ["view"])


@query(
    "ordered_concat",
    """SELECT n_regionkey, part, string_agg(n_name, ',' ORDER BY n_name) AS joined
       FROM (SELECT *, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1) // 3 AS part
             FROM (SELECT DISTINCT n_regionkey, n_name FROM nation))
       GROUP BY n_regionkey, part""",
)
def ordered_concat(spark, sf):
    return ordering.ordered_concat(table(spark, sf, "nation"), "n_regionkey", "n_name", 3)
