"""What keeps jobs in proportion: parsed once, solved in rows, pruned by bucket, published by pointer."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fixture_documents import document, frame, node, workflow
from weirstone.functions import rules
from weirstone.operators import catalogue, dated, graph, layers, quality, reconcile, routing, setops
from weirstone.plans import catalogue as catalogue_plans
from weirstone.sources import publish
from weirstone.sources.documents import parse_with_rejects
from weirstone.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pruning_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return str(re.findall(r"PartitionFilters: \[([^\]]*)", text) or re.findall(r"[a-z]*lters: \[([^\]]*)\], PushedFilters", text))


@pytest.mark.parametrize("name", ["catalogue_nodes", "catalogue_edges", "migration_matrix", "routed_nodes", "variable_registry"])
def test_no_parse_in_catalogue_plans(spark, sf, name):
    plan = plan_of(getattr(catalogue_plans, name)(spark, sf))
    assert "from_json" not in plan and "JsonToStructs" not in plan


def test_rejects_keep_their_text(spark):
    texts = spark.createDataFrame(
        [("a", '{"spec": {"id": "x", "nodes": []}}'), ("b", '{"spec": '), ("c", None), ("d", " "), ("e", '{"spec": 5}'), ("f", "{}")],
        "f string, v string",
    )
    good, bad = parse_with_rejects(texts, "v", "f")
    assert sorted(r.source_file for r in good.collect()) == ["a", "f"]
    assert dict(rows(bad)) == {"b": '{"spec": ', "c": None, "d": " ", "e": '{"spec": 5}'}


def _strong(nodes, edges):
    reach = {n: {n} for n in nodes}
    for _ in nodes:
        for a, b in edges:
            reach[a] = reach[a] | reach[b]
    on = {n for n in nodes if any(a == n and n in reach[b] for a, b in edges)}
    return {n: min(m for m in on if m in reach[n] and n in reach[m]) for n in on}


@pytest.mark.parametrize("seed", range(2))
def test_components_match_brute_force(spark, seed):
    rng = random.Random(seed)
    groups = {}
    for g in "pq":
        nodes = list(range(14))
        edges = {(rng.randrange(14), rng.randrange(14)) for _ in range(17)}
        groups[g] = (nodes, sorted(edges))
    df = spark.createDataFrame([(g, n) for g, (ns, _) in groups.items() for n in ns], "g string, node int")
    ed = spark.createDataFrame([(g, a, b) for g, (_, es) in groups.items() for a, b in es], "g string, node int, upstream int")
    found = {(r.g, r.node): r.component for r in graph.cycle_components(df, ed, ["g"]).collect()}
    assert found == {(g, n): c for g, (ns, es) in groups.items() for n, c in _strong(ns, es).items()}


def test_a_node_between_two_cycles_is_on_none(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 7)], "node int")
    ed = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (4, 3), (4, 5), (5, 4), (6, 5)], "node int, upstream int")
    assert rows(graph.cyclic_nodes(df, ed)) == [(1, True), (2, True), (3, False), (4, True), (5, True), (6, False)]
    assert rows(graph.cycle_components(df, ed)) == [(1, 1), (2, 1), (4, 4), (5, 4)]
    assert graph.cycle_components(df, ed.limit(0)).count() == 0


def test_graph_tables_are_not_broadcast_and_cycles_cost_no_rounds(spark, monkeypatch):
    # 64 cycles of two nodes beside a chain of nine: before, rounds went on until they passed the number of nodes on cycles
    labels, store = [], graph.materialise
    monkeypatch.setattr(graph, "materialise", lambda df, label: (labels.append((label, plan_of(df))), store(df, label))[1])
    pairs = [(100 + i, 100 + (i ^ 1)) for i in range(128)] + [(i, i - 1) for i in range(1, 10)]
    df = spark.createDataFrame([(n,) for n, _ in pairs] + [(0,)], "node int")
    ed = spark.createDataFrame(pairs, "node int, upstream int")
    levels = graph.topological_levels(df, ed)
    assert dict(rows(levels)) == {n: n if n < 10 else None for n in [0, *[n for n, _ in pairs]]}
    assert [name for name, _ in labels].count("anchors") <= 6  # the start, four rounds for nine steps, one that settles none
    assert len(rows(graph.cycle_components(df, ed))) == 128
    assert not [name for name, plan in labels if "Broadcast" in plan] and "Broadcast" not in plan_of(levels)


@pytest.mark.parametrize("limit", [0, 30, 512])
def test_levels_do_not_depend_on_the_row_limit(spark, limit):
    rng = random.Random(3)
    pairs = [(g, n) for g in range(6) for n in range(4 * g + 1)]
    edges = [(g, n, rng.randrange(4 * g + 1)) for g, n in pairs if n and rng.random() < 0.8]
    df = spark.createDataFrame(pairs, "g int, node int")
    ed = spark.createDataFrame(edges, "g int, node int, upstream int")
    expected = {}
    for g in range(6):
        known, own = {}, [e for e in edges if e[0] == g]
        for _ in range(40):
            for n in range(4 * g + 1):
                ups = [u for _, m, u in own if m == n]
                if all(u in known for u in ups):
                    known[n] = 1 + max((known[u] for u in ups), default=-1)
        expected.update({(g, n): known.get(n) for n in range(4 * g + 1)})
    found = {(r.g, r.node): r.level for r in graph.topological_levels(df, ed, ["g"], row_limit=limit).collect()}
    assert found == expected


def test_insert_ignore_reads_its_buckets_only(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    df = spark.range(400).select(F.col("id").alias("k"), F.lit("first").alias("v"))
    df.write.parquet(source)
    stream = lambda: ingest.landed(spark, source, df.schema)
    assert ingest.run_insert_ignore(stream(), path, str(tmp_path / "c"), ["k"], ["v"], buckets=8) == 400
    late = spark.createDataFrame([(7, "late"), (1000, "new"), (1000, "old")], "k bigint, v string")
    late.write.mode("append").parquet(source)
    ingest.run_insert_ignore(stream(), path, str(tmp_path / "c"), ["k"], ["v"], buckets=8)
    found = dict(rows(ingest.stored_rows(spark, path, df.schema)))
    assert len(found) == 401 and found[7] == "first" and found[1000] == "new"
    assert "(key_bucket" in pruning_of(ingest.stored_rows(spark, path, df.schema, [3]))
    assert ingest.stored_rows(spark, path, df.schema, [3]).count() < 400


def test_complete_groups_come_once(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "full")
    expected = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1)], "p string, c int")
    for batch in ([("a", 1), ("x", 1)], [("a", 1), ("c", 9)], [("a", 2), ("a", 2), ("b", 1)], [("a", 1), ("b", 1)]):
        spark.createDataFrame(batch, "p string, c int").coalesce(1).write.mode("append").parquet(source)
        ingest.run_complete_groups(ingest.landed(spark, source, expected.schema), expected, path, str(tmp_path / "c"), "p", ["c"])
    done = spark.read.schema("p string, n_expected bigint, n_stored bigint").parquet(path).select("p", "n_expected", "n_stored")
    assert rows(done) == [("a", 2, 2), ("b", 1, 1)]


def test_complete_groups_keep_children_in_a_table(spark, tmp_path):
    source, path, mark = (str(tmp_path / n) for n in ("in", "full", "c"))
    schema = "p string, c int"
    early = spark.createDataFrame([("a", 1)], schema)
    late = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("n", 1), ("n", None), (None, 1)], schema)
    # b's second child lands before it is expected; a null child never lands
    for batch, expected in (([("a", 1), ("b", 2)], early), ([("b", 1), ("n", 1), ("n", None), (None, 1), ("a", 1)], late)):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        ingest.run_complete_groups(ingest.landed(spark, source, early.schema), expected, path, mark, "p", ["c"])
    done = spark.read.schema("p string, n_expected bigint, n_stored bigint").parquet(path).select("p", "n_expected", "n_stored")
    assert rows(done) == [("a", 1, 1), ("b", 2, 2)]
    assert not (tmp_path / "c" / "state").exists()


def test_chain_rollup_counts_like_count_distinct(spark):
    df = spark.range(4000).selectExpr(
        "id % 3 AS k", "IF(id % 50 = 0, NULL, id % 500) AS o", "IF(id % 50 = 0, NULL, id % 500 % 40) AS u",
        "IF(id % 9 = 0, NULL, id % 7) AS p", "id AS m",
    )
    df = df.withColumn("k", F.nullif("k", F.lit(2)))
    ours = layers.chain_rollup(df, ["k"], [("os", "o"), ("us", "u")], {"ps": "p"}, {"m": F.col("m")})
    plain = df.groupBy("k").agg(F.count_distinct("o"), F.count_distinct("u"), F.sum("m"), F.count_distinct("p"))
    assert rows(ours.select("k", "os", "us", "m", "ps")) == rows(plain)
    assert "Expand" not in plan_of(ours)


def test_merged_sketches_are_near(spark):
    df = spark.range(30_000).selectExpr("id % 30 AS day", "id % 7000 AS u")
    days = layers.daily_sketches(df, ["day"], {"u": "u"})
    near = layers.merged_counts(days.withColumn("w", F.lit(1)), ["w"], ["u"]).first().u
    assert abs(near - 7000) < 0.065 * 7000


def test_drilldown_finds_what_differs(spark, tmp_path):
    source = spark.range(3000).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS v")
    target = source.where("k <> 11").withColumn("v", F.when(F.col("k") == 12, "x").otherwise(F.col("v")))
    target = target.unionByName(spark.createDataFrame([(5000, "n"), (13, "6")], "k bigint, v string"))
    paths = [str(tmp_path / n) for n in "ab"]
    schema = [reconcile.land_by_key(d, p, ["k"], 16) for d, p in zip((source, target), paths)][0]
    found = reconcile.drilldown(spark, *paths, schema, ["k"])
    assert rows(found) == rows(setops.row_difference(source, target)) and found.count() == 5
    assert "bucket" in pruning_of(found)
    same = reconcile.drilldown(spark, paths[0], paths[0], schema, ["k"])
    assert same.count() == 0


@pytest.mark.parametrize(
    "text, warehouse, kind, flagged",
    [
        ("ARRAY<DATETIME>", "ARRAY<DATETIME>", "array<timestamp_ntz>", False),
        ("map< string , array<int> >", "ARRAY<STRUCT<key STRING, value ARRAY<INT64>>>", "map<string, array<int>>", False),
        ("STRUCT<a:INT,b:MAP<STRING,FOO>>", "STRUCT<A:INT,B:MAP<STRING,FOO>>", "struct<a:int, b:map<string, FOO>>", True),
        ("ARRAY<DECIMAL(50,2)>", "ARRAY<BIGNUMERIC>", "array<DECIMAL(50,2)>", True),
        ("ARRAY<INT", "ARRAY<INT", "ARRAY<INT", True),
        ("MAP<INT,INT,INT>", "MAP<INT,INT,INT>", "MAP<INT,INT,INT>", True),
        ("ARRAY<>", "ARRAY<>", "ARRAY<>", True),
        ("", "", "", True),
        (None, "", "", True),
        ("INT INT", "INT INT", "INT INT", True),
    ],
)
def test_nested_types(spark, text, warehouse, kind, flagged):
    df = spark.createDataFrame([(text,)], "t string").select(rules.type_parts(F.col("t")).alias("p")).select("p.*")
    assert tuple(df.first()) == (warehouse, kind, flagged)


def test_rule_table_takes_the_first_match(spark):
    rows_of = [
        (1, "PY", "nocase head", "select", "sql", "a"), (2, "PY", "holds", "spark", "heavy", "b"), (2, "PY", "holds", "join", "join", "c"),
        (5, None, "nocase holds", "SECRET", "review", "d"), (9, "PY", None, None, "light", "e"), (1, "PY", "odd", "x", "never", "f"),
    ]
    table = spark.createDataFrame(rows_of, "priority int, command string, test string, marker string, target string, reason string")
    nodes = spark.createDataFrame(
        [(1, "PY", " \n Select 1"), (2, "PY", "x join spark"), (3, "PY", "a secret"), (4, "PY", None), (5, "SH", "my Secret"), (6, "SH", "x"), (7, None, "secret")],
        "n int, command string, body string",
    )
    found = routing.route(nodes, table, "command", "body")
    assert [tuple(r) for r in found.orderBy("n").select("n", "target").collect()] == [
        (1, "sql"), (2, "join"), (3, "review"), (4, "light"), (5, "review"), (6, None), (7, None),
    ]
    assert [r.target for r in routing.unknown_tests(table).collect()] == ["never"]
    assert routing.route(nodes, table.limit(0), "command", "body").where("target IS NOT NULL").count() == 0


def test_routing_does_not_shuffle_nodes(spark):
    # the size of frames made from Python rows is not known to the optimizer, as that of a large table
    rules_ = spark.createDataFrame(
        [(2, "PY", "holds", "x", "own"), (1, None, "holds", "y", "any"), (3, None, None, None, "rest")],
        "priority int, command string, test string, marker string, target string",
    ).withColumn("reason", F.lit(None).cast("string"))
    nodes = spark.createDataFrame([(1, "PY", "x y"), (2, "PY", "x"), (3, "PY", ""), (4, "SH", "x")], "n int, command string, body string")
    found = routing.route(nodes, rules_, "command", "body")
    assert "hashpartitioning" not in plan_of(found) and "SortMergeJoin" not in plan_of(found)
    assert rows(found.select("n", "target")) == [(1, "any"), (2, "own"), (3, "rest"), (4, "rest")]


def test_backfill_computes_what_changed(spark, tmp_path):
    source, mart, manifest = (str(tmp_path / n) for n in ("s", "m", "f"))
    roll = lambda d: d.groupBy("pt").agg(F.sum("v").alias("v"))
    first = spark.sql("SELECT id AS v, concat('d', id % 3) AS pt FROM range(30)")
    land = dated.land(first, source)
    read = lambda: spark.read.schema("v bigint, pt string").parquet(source)
    assert dated.backfill(read(), roll, mart, manifest, 1) == 3
    assert dated.backfill(read(), roll, mart, manifest, 2) == 0
    dated.land(spark.createDataFrame([(7, "d1"), (1, "d9")], "v bigint, pt string"), source)
    assert dated.backfill(read(), roll, mart, manifest, 3) == 2
    assert rows(spark.read.schema("v bigint, pt string").parquet(mart)) == sorted([(135, "d0"), (155, "d2"), (1, "d9"), (7, "d1")], key=str)
    assert land.schema.names == ["v"]


def test_a_failing_load_does_not_show(spark, tmp_path):
    root = str(tmp_path / "t")
    gate = lambda df: quality.min_rows_gate(df, "k", 2)
    two, one = spark.createDataFrame([(1,), (1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    with pytest.raises(ValueError):
        publish.read_published(spark, root)
    assert publish.write_audit_publish(two, root, gate)
    assert not publish.write_audit_publish(one, root, gate)
    assert not publish.write_audit_publish(two.limit(0), root, gate)
    publish.write_version(one, root)
    assert rows(publish.read_published(spark, root)) == [(1,), (1,)]
    assert publish.write_audit_publish(two.selectExpr("k + 1 AS k"), root, gate)
    assert rows(publish.read_published(spark, root)) == [(2,), (2,)] and rows(publish.read_published(spark, root, 1)) == [(1,), (1,)]


def test_models_that_read_each_other(spark):
    def sql(ident, reads, writes):
        body = f"INSERT OVERWRITE TABLE p.{writes} SELECT * FROM p.{reads};"
        return node(ident, "ODPS_SQL", body, reads=[f"odps.p.{reads}"], writes=[f"odps.p.{writes}"])

    loop = workflow("loop", [sql("a", "y", "x"), sql("b", "x", "y")])
    line = workflow("line", [sql("a", "raw", "x"), sql("b", "x", "y"), node("c", "PYODPS", "print(1)", writes=["odps.p.z"])])
    cat = catalogue.build_catalogue(frame(spark, [document(loop), document(line)])).stored()
    models = catalogue.deployable_models(catalogue.routed_nodes(catalogue.in_run_order(cat)))
    assert rows(catalogue.model_links(models)) == [("line", "y", "x"), ("loop", "x", "y"), ("loop", "y", "x")]
    schedules = cat.workflows.select("workflow_id", F.col("cron").alias("schedule"))
    found = {r.workflow_id: (r.n_models, r.n_missing, r.cyclic, r.ok) for r in catalogue.built_parity(cat, models, schedules).collect()}
    assert found == {"loop": (2, 0, True, False), "line": (2, 1, False, False)}


def test_rebuilt_documents_have_headers_and_each_node_once(spark):
    cat = catalogue.build_catalogue(frame(spark, [document(workflow("w", [node("a", "VIRTUAL"), node("a", "PYODPS"), node("b", "VIRTUAL")]))]))
    nested = catalogue.renest(cat.nodes, 10).first()
    assert nested.spec.type == "CycleWorkflow" and nested.spec.name == "workflow_w"
    flow = nested.spec.workflows[0]
    assert [(n.id, n.script.runtime.command) for n in flow.nodes] == [("a", "VIRTUAL"), ("b", "VIRTUAL")]
    assert flow.variables == [] and flow.trigger.cron is None
    heads = spark.sql("SELECT 'w' AS workflow_id, 'Mine' AS workflow_name")
    assert catalogue.renest(cat.nodes, 10, heads).first().spec.workflows[0].name == "Mine"
