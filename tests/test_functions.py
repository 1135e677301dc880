"""Scalar cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirstone.functions import canonical, names, rules, rundate
from weirstone.operators import corpus


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("r")).first().r


@pytest.mark.parametrize("text, wanted", [
    ("00 02 00 * * ?", "02 00 * * *"), ("02 00 * * *", "02 00 * * *"), ("  00  02 00 1 * ? 2024", "02 00 1 * *"), ("@daily", "@daily"),
])
def test_schedule(spark, text, wanted):
    assert one(spark, rundate.five_field_schedule(F.col("c")), c=text) == wanted


def test_run_date(spark):
    day = dt.date(2024, 3, 1)
    assert one(spark, rundate.bizdate(F.col("d")), d=day) == "20240229"
    assert one(spark, rundate.run_day(F.col("d")), d=day) == "20240301"
    assert one(spark, rundate.cycle_time(F.col("d")), d=dt.datetime(2024, 3, 1, 4, 5)) == "202403010405"
    assert one(spark, rundate.shift_day(F.col("d"), -1), d="20240301") == "20240229"
    assert one(spark, rundate.shift_day(F.col("d"), 7), d="20240225") == "20240303"


@pytest.mark.parametrize("text, wanted, flagged", [
    ("INT", "INT64", False), ("bigint", "INT64", False), ("FLOAT", "FLOAT64", False), ("BOOLEAN", "BOOL", False),
    ("BINARY", "BYTES", False), ("DECIMAL(10,2)", "NUMERIC", False), ("DECIMAL(50, 10)", "BIGNUMERIC", True),
    ("VARCHAR(9)", "STRING", False), ("MAP<STRING, BIGINT>", "ARRAY<STRUCT<key STRING, value INT64>>", False),
    ("ARRAY<INT>", "ARRAY<INT64>", False), ("interval", "INTERVAL", True), ("DECIMAL", "DECIMAL", True),
])
def test_types(spark, text, wanted, flagged):
    assert one(spark, rules.warehouse_type(F.col("t")), t=text) == wanted
    assert one(spark, rules.type_flag(F.col("t")), t=text) is flagged


@pytest.mark.parametrize("command, content, target", [
    ("PYODPS", "print('loaded')", "PythonOperator"),
    ("PYODPS", "  \n SELECT 1", "Dataform .sqlx"),
    ("PYTHON", "x = client.read_sql('q').join(y)", "Dataflow (Beam)"),
    ("VIRTUAL", None, "EmptyOperator"),
    ("ODPS_SQL", "select 1", "Dataform .sqlx"),
    ("DIDE_SHELL", "ls", "TRIAGE"),
    ("", "", "TRIAGE"),
])
def test_routing(spark, command, content, target):
    found, _ = rules.route_for_build(F.col("c"), F.col("s"))
    row = spark.createDataFrame([(command, content)], "c string, s string").select(found.alias("t")).first()
    assert row.t == target


def test_long_scripts_can_go_to_review(spark):
    found, reason = rules.route_for_build(F.col("c"), F.col("s"), max_chars=5)
    row = spark.createDataFrame([("PYTHON", "print(1)")], "c string, s string").select(found.alias("t"), reason.alias("r")).first()
    assert row.t == "TRIAGE" and "5" in row.r


@pytest.mark.parametrize("text, wanted", [("My Flow-01!", "my_flow_01"), ("__a__", "a"), ("???", "model"), ("x" * 70, "x" * 60)])
def test_identifier(spark, text, wanted):
    assert one(spark, names.identifier(F.col("n")), n=text) == wanted


def test_last_part_and_json(spark):
    assert one(spark, names.last_part(F.col("g")), g="a.b.c") == "c"
    assert one(spark, names.last_part(F.col("g")), g="c") == "c"
    assert one(spark, names.json_field(F.col("j"), "$.a.b", "none"), j='{"a": 1}') == "none"
    assert one(spark, names.json_field(F.col("j"), "$.a.b", "none"), j='{"a": {"b": "x"}}') == "x"


def test_scaled(spark):
    rows = spark.createDataFrame([(12.345,), (-0.125,), (float("nan"),), (1e300,), (None,)], "x double")
    assert [r.v for r in rows.select(canonical.scaled(F.col("x")).alias("v")).collect()] == [1235, -13, None, None, None]


def test_wide_sum_is_exact(spark):
    values = [2**60, 2**60 + 1, -(2**59), -1, 2**61 + 12345]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    assert int(df.agg(canonical.wide_sum(F.col("x")).alias("s")).first().s) == sum(values)


def test_function_usage(spark):
    text = "SELECT nvl(IF(IF(a)), x.NVL(b)), my_if(c) FROM t LATERAL VIEW explode(d) e"
    df = spark.createDataFrame([(1, text), (2, "no calls")], "id int, s string")
    assert {(r.token, r.action, r.n) for r in corpus.function_usage(df, "id", "s").collect()} == {
        ("NVL", "rename", 1), ("IF", "rename", 2), ("LATERAL", "review", 1), ("EXPLODE", "review", 1)}
    assert {r.token for r in corpus.function_usage(df, "id", "s", case_sensitive=True).collect()} == {"IF", "LATERAL"}


def test_variables(spark):
    text = "a = '${bizdate}' and b = '$[yyyymmdd-1]' and c = '$[yyyymmdd +7]' and d = $[cyctime-1] and e = $[foo-1] and f = ${bizdate}"
    df = spark.createDataFrame([(1, text)], "id int, s string")
    declared = spark.createDataFrame([("bizdate",), ("yyyymmdd",), ("cyctime",)], "name string")
    found = {(r.form, r.name, r.day_offset, r.status) for r in corpus.variable_findings(df, ["id"], "s", declared).collect()}
    assert found == {
        ("brace", "bizdate", None, "resolved"), ("bracket", "yyyymmdd", -1, "resolved"), ("bracket", "yyyymmdd", 7, "resolved"),
        ("bracket", "cyctime", -1, "offset_not_allowed"), ("bracket", "foo", -1, "unresolved")}


def test_statements_and_lines(spark):
    text = "SET x=1;\nCREATE TABLE a (b INT); insert into a select ';';\nDROP TABLE c;TRUNCATE TABLE d;\nALTER TABLE e;\n# note\nwith q select 1;"
    df = spark.createDataFrame([(1, text)], "id int, s string")
    r = corpus.statement_kinds(df, ["id"], "s").first()
    assert (r.n_create, r.n_insert, r.n_drop_table, r.n_truncate_table, r.n_other, r.n_query) == (1, 1, 1, 1, 1, 2)
    kept = corpus.drop_lines(df, ["id"], "s", corpus.DIRECTIVE_PREFIXES).first()
    assert (kept.n_dropped, "SET" in kept.kept_text, "# note" in kept.kept_text) == (2, False, False)


def test_table_references(spark):
    text = "SELECT * FROM `p.a` JOIN q.b ON 1 = 1 JOIN a x"
    df = spark.createDataFrame([(1, text)], "id int, s string")
    assert {r.table_name for r in corpus.table_references(df, ["id"], F.col("s")).collect()} == {"a", "b"}
    assert one(spark, corpus.insert_body(F.col("s")), s="insert overwrite table a.b partition (pt='1')\nselect 1 ; \n") == "select 1"
