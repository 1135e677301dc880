"""Sinks, sources, streams and the shared folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone import session
from weirstone.plans.registry import table
from weirstone.sources import delimited, tables
from weirstone.streaming import ingest


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partition_overwrite_touches_its_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "20240101"), (2, "20240101"), (3, "20240102")], "x int, pt string")
    tables.overwrite_partitions(days, path)
    rerun = spark.createDataFrame([(9, "20240101")], "x int, pt string")
    for _ in range(2):
        tables.overwrite_partitions(rerun, path)
        assert rows(tables.read_partitioned(spark, path, days.schema)) == [(3, "20240102"), (9, "20240101")]
    one = tables.read_partitioned(spark, path, days.schema, value="20240102")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in plan and rows(one) == [(3, "20240102")]


def test_run_parameters_reach_the_scan(spark, sf):
    from weirstone.operators.layers import load_source

    df = load_source(table(spark, sf, "orders"), ["o_orderkey"], "o_orderpriority = :p AND o_custkey > :c", {"p": "1-URGENT", "c": 5})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan and "o_custkey#" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan


def test_quarantine(spark, tmp_path):
    (tmp_path / "in.txt").write_text('1;a;2.5\n2;b\n3;c;1.0;x\nz;d;1.0\n4;"e";\n')
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType())])
    good, bad = delimited.scan_with_quarantine(spark, str(tmp_path), schema)
    assert rows(good) == [(1, "a", 2.5), (4, "e", None)]
    assert rows(bad) == [("2;b",), ("3;c;1.0;x",), ("z;d;1.0",)]
    assert (good.count(), bad.count()) == (2, 3)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        delimited.scan_delimited(spark, str(tmp_path), schema).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        delimited.scan_delimited(spark, str(tmp_path), schema).select("s").collect()


def test_standardise(spark):
    df = spark.createDataFrame([('"x"', "yes"), ("y", "no"), ("z", None)], ["emp.rate", "y"])
    out = delimited.standardise(df, {"emp.rate": "emp_rate"}, ["emp_rate"], {"y": "yes"})
    assert rows(out) == [("x", 1), ("y", 0), ("z", 0)]


def test_audit(spark, tmp_path):
    for day in ("20240101", "20240102"):
        tables.write_with_audit(spark.range(7), str(tmp_path / "t"), str(tmp_path / "log"), "w", day)
    log = spark.read.parquet(str(tmp_path / "log")).collect()
    assert sorted((r.bizdate, r.status, r.rows_written) for r in log) == [("20240101", "SUCCESS", 7), ("20240102", "SUCCESS", 7)]


def test_resumable_append(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    spark.range(5).coalesce(1).write.parquet(src)
    schema = spark.range(1).schema
    assert ingest.run_append(ingest.landed(spark, src, schema), out, mark) == 5
    assert ingest.run_append(ingest.landed(spark, src, schema), out, mark) == 0
    spark.range(5, 9).coalesce(1).write.mode("append").parquet(src)
    assert ingest.run_append(ingest.landed(spark, src, schema, files_per_batch=1), out, mark) == 4
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(9)]


def test_insert_ignore_keeps_the_first_write(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "id long, at long, v string"

    def land(*values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(src)

    def run(mark):
        stream = ingest.landed(spark, src, spark.createDataFrame([], schema).schema)
        ingest.run_insert_ignore(stream, out, str(tmp_path / mark), ["id"], ["at"])

    land((1, 2, "b"), (1, 1, "a"), (2, 1, "x"))
    run("m")
    land((1, 0, "late"), (3, 1, "y"))
    run("m")
    run("lost")  # without its checkpoint everything comes again
    assert rows(spark.read.parquet(out)) == [(1, 1, "a"), (2, 1, "x"), (3, 1, "y")]


def test_dedupe_over_runs(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    for start in (0, 3):
        spark.range(start, start + 5).unionAll(spark.range(start, start + 5)).coalesce(1).write.mode("append").parquet(src)
        ingest.run_dedupe(ingest.landed(spark, src, spark.range(1).schema), out, mark, ["id"])
    assert rows(spark.read.parquet(out)) == [(i,) for i in range(8)]


def test_dedupe_with_bounded_state(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, at), (1, at), (2, at)], "id long, at timestamp")
    df.coalesce(1).write.parquet(src)
    ingest.run_dedupe(ingest.landed(spark, src, df.schema), out, mark, ["id"], "at", "1 hour")
    assert rows(spark.read.parquet(out).select("id")) == [(1,), (2,)]


class _Named:
    """A session whose cluster names the shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "hdfs://shared/checkpoints/" if key == "spark.checkpoint.dir" else default


class _Unnamed:
    """A cluster session without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_shared_root(spark):
    assert session.shared_root(_Named) == "hdfs://shared/checkpoints"
    with pytest.raises(RuntimeError):
        session.shared_root(_Unnamed)
    root = session.shared_root(spark)
    assert session.shared_root(spark) == root
    assert session.materialise(spark.range(3), "probe").count() == 3
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_rollup_exact_and_approximate(spark):
    from weirstone.operators.layers import daily_rollup

    rows_in = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") % 100).alias("u"), F.lit(2).alias("m"))
    exact = daily_rollup(rows_in, ["k"], {"users": "u"}, {"total": F.col("m")})
    assert rows(exact) == [(0, 50, 3000), (1, 50, 3000)]
    near = daily_rollup(rows_in, ["k"], {"users": "u"}, {"total": F.col("m")}, approximate=True)
    assert all(45 <= r.users <= 55 and r.total == 3000 for r in near.collect())


def test_dated_pipeline_reads_one_day(spark, tmp_path):
    from weirstone.operators import dated

    a = dated.land(spark.sql("SELECT id AS k, concat('d', id % 3) AS pt FROM range(30)"), str(tmp_path / "a"))
    b = dated.land(spark.sql("SELECT id AS k, id * 2 AS v, concat('d', id % 3) AS pt FROM range(30)"), str(tmp_path / "b"))
    facts = dated.day_facts(spark, a, b, ["k"], "d1")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(pt") == 2
    roll = lambda d: d.groupBy("pt").agg(F.sum("v").alias("v"))
    folders = [str(tmp_path / n) for n in ("facts", "mart", "audit")]
    run = lambda pt, least: dated.run_day(spark, dated.day_facts(spark, a, b, ["k"], pt), roll, *folders, pt, least)
    assert [run("d1", 5), run("d1", 5), run("d2", 11), run("none", 1)] == ["PASS", "PASS", "FAIL", "FAIL"]
    mart = spark.read.schema("v bigint, pt string").parquet(folders[1])
    assert rows(mart) == [(290, "d1")]
    audit = rows(spark.read.schema(dated.AUDIT).parquet(folders[2]))
    assert audit == [("d1", 10, 5, "PASS"), ("d1", 10, 5, "PASS"), ("d2", 10, 11, "FAIL"), ("none", 0, 1, "FAIL")]


def test_documents_that_do_not_parse_come_out(spark, tmp_path):
    from weirstone.sources.documents import scan_with_rejects

    for name, text in {"good": '{"spec": {"id": "a", "nodes": []}}', "cut": '{"spec": {"id": "a", ', "blank": " \n"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, bad = scan_with_rejects(spark, str(tmp_path))
    assert rows(good.select("source_file", "spec.id")) == [("good.json", "a")]
    assert sorted(r.source_file for r in bad.collect()) == ["blank.json", "cut.json"]
