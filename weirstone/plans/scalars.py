"""Scalar functions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions import names, rundate
from weirstone.plans.registry import query, table


@query(
    "fn_conditional",
    """SELECT c_custkey, COALESCE(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, 'none') AS nvl_value,
              CASE WHEN c_nationkey < 10 THEN 'low' ELSE 'high' END AS if_value,
              COALESCE(CASE WHEN c_nationkey = 1 THEN 'a' END, CASE WHEN c_nationkey = 2 THEN 'b' END, 'c') AS coalesce_value
       FROM customer""",
)
def fn_conditional(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "nvl(if(c_acctbal > 0, c_mktsegment, null), 'none') AS nvl_value",
        "if(c_nationkey < 10, 'low', 'high') AS if_value",
        "coalesce(if(c_nationkey = 1, 'a', null), if(c_nationkey = 2, 'b', null), 'c') AS coalesce_value",
    )


@query(
    "fn_string",
    """SELECT p_partkey, p_brand || '/' || p_type AS joined, length(p_name) AS name_length, upper(p_name) AS upper_name,
              lower(p_type) AS lower_type, trim('  ' || p_name || ' ') AS trimmed FROM part""",
)
def fn_string(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.length("p_name").cast("bigint").alias("name_length"),
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, CAST(ROUND(ABS(c_acctbal) * 100) AS BIGINT) AS abs_cents, CAST(ROUND(c_acctbal) AS BIGINT) AS rounded,
              CAST(ROUND(GREATEST(c_acctbal, 0) * 100) AS BIGINT) AS at_least_zero,
              CAST(ROUND(LEAST(c_acctbal, 1000) * 100) AS BIGINT) AS at_most_thousand FROM customer""",
)
def fn_math(spark, sf):
    balance = F.col("c_acctbal")
    cents = lambda c: F.round(c * 100).cast("bigint")
    return table(spark, sf, "customer").select(
        "c_custkey",
        cents(F.abs(balance)).alias("abs_cents"),
        F.round(balance).cast("bigint").alias("rounded"),
        cents(F.greatest(balance, F.lit(0.0))).alias("at_least_zero"),
        cents(F.least(balance, F.lit(1000.0))).alias("at_most_thousand"),
    )


@query(
    "fn_regex",
    """SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
              regexp_replace(url, '[0-9]+', '#', 'g') AS url_shape FROM pages""",
)
def fn_regex(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_replace("url", "[0-9]+", "#").alias("url_shape"),
    )


@query("fn_to_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def fn_to_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@query(
    "fn_date_arith",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) + INTERVAL 30 DAY AS DATE) AS due,
              date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days_to_ship,
              CAST(date_part('year', l_shipdate) AS BIGINT) AS ship_year, CAST(date_part('month', l_shipdate) AS BIGINT) AS ship_month
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def fn_date_arith(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.date_add("l_shipdate", 30).alias("due"),
        F.datediff("l_shipdate", "o_orderdate").cast("bigint").alias("days_to_ship"),
        F.date_part(F.lit("year"), "l_shipdate").cast("bigint").alias("ship_year"),
        F.date_part(F.lit("month"), "l_shipdate").cast("bigint").alias("ship_month"),
    )


@query(
    "fn_epoch",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text_time FROM events""",
)
def fn_epoch(spark, sf):
    # Reading and writing the wall clock in the same zone cancels the session zone out.
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        "event_id",
        F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("seconds"),
        F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss").alias("text_time"),
    )


@query(
    "fn_split_part",
    """SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail FROM customer""",
)
def fn_split_part(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("head"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("tail"),
    )


@query(
    "fn_explode",
    """SELECT vec_id, CAST(i - 1 AS BIGINT) AS pos, CAST(ROUND(CAST(embedding[i] AS DOUBLE) * 1000000) AS BIGINT) AS value
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def fn_explode(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    value = F.round(F.col("x").cast("double") * 1000000).cast("bigint")
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), value.alias("value"))


@query(
    "fn_stack",
    """SELECT l_returnflag, 'quantity' AS measure, CAST(SUM(CAST(ROUND(l_quantity * 100) AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1
       UNION ALL
       SELECT l_returnflag, 'price', CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) FROM lineitem GROUP BY 1""",
)
def fn_stack(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(F.round(F.col("l_quantity") * 100).cast("bigint")).alias("quantity"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("price"),
    )
    return totals.unpivot("l_returnflag", ["quantity", "price"], "measure", "total")


@query(
    "run_date_vars",
    """SELECT event_id, strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS bizdate,
              strftime(ts, '%Y%m%d') AS yyyymmdd, strftime(ts, '%Y%m%d%H%M') AS cyctime FROM events""",
)
def run_date_vars(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", rundate.bizdate(ts).alias("bizdate"), rundate.run_day(ts).alias("yyyymmdd"),
        rundate.cycle_time(ts).alias("cyctime"),
    )


@query(
    "run_date_offset",
    """SELECT event_id, strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS day_before,
              strftime(CAST(ts AS DATE) + INTERVAL 7 DAY, '%Y%m%d') AS week_after,
              CASE WHEN event_type = 'click' THEN strftime(CAST(ts AS DATE) + INTERVAL 40 DAY, '%Y%m%d') END AS named
       FROM events""",
)
def run_date_offset(spark, sf):
    day = rundate.run_day(F.col("ts"))
    name = F.when(F.col("event_type") == "click", "yyyymmdd").otherwise("cyctime")
    return table(spark, sf, "events").select(
        "event_id",
        rundate.shift_day(day, -1).alias("day_before"),
        rundate.shift_day(day, 7).alias("week_after"),
        rundate.offset_value(name, day, F.lit(40)).alias("named"),
    )


@query(
    "schedule_normalise",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%M %H * * *')
                             ELSE strftime(ts, '%M %H * * *') END AS schedule FROM events""",
)
def schedule_normalise(spark, sf):
    six = F.date_format("ts", "'00'  mm HH '* * ?'")
    five = F.date_format("ts", "mm HH '* * *'")
    cron = F.when(F.col("event_id") % 5 == 0, five).otherwise(six)
    return table(spark, sf, "events").select("event_id", rundate.five_field_schedule(cron).alias("schedule"))


@query(
    "normalise_identifier",
    """SELECT p_partkey, COALESCE(nullif(substr(lower(regexp_replace(regexp_replace('  ' || p_name || '--' || p_brand,
              '[^a-zA-Z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 60), ''), 'model') AS ident FROM part""",
)
def normalise_identifier(spark, sf):
    name = F.concat(F.lit("  "), "p_name", F.lit("--"), "p_brand")
    return table(spark, sf, "part").select("p_partkey", names.identifier(name).alias("ident"))


@query("last_name_part", "SELECT page_id, split_part(url, '/', -1) AS last_part FROM pages")
def last_name_part(spark, sf):
    return table(spark, sf, "pages").select("page_id", names.last_part(F.col("url"), "/").alias("last_part"))


@query(
    "json_path_default",
    """SELECT event_id, COALESCE(json_extract_string(props, '$.k'), '') AS k,
              COALESCE(json_extract_string(props, '$.runtime.command'), 'none') AS command FROM events""",
)
def json_path_default(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", names.json_field(F.col("props"), "$.k").alias("k"),
        names.json_field(F.col("props"), "$.runtime.command", "none").alias("command"),
    )


@query(
    "map_entries",
    """SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events
       UNION ALL SELECT event_id, 'user', user_id FROM events""",
)
def map_entries(spark, sf):
    props = F.from_json("props", "map<string,bigint>")
    both = F.map_concat(props, F.create_map(F.lit("user"), F.col("user_id")))
    again = names.from_entries(names.entries(both))
    return table(spark, sf, "events").select("event_id", F.inline(names.entries(again)))
