"""Catalogue jobs on authored documents."""

import json

import pytest
from pyspark.sql import functions as F

from fixture_documents import document, flow_of, frame, library, node, weather, workflow
from weirstone.operators import catalogue, graph, joins
from weirstone.sources.documents import normalise, parse_documents, prefer_then_fallback, scan_documents


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def built(spark, *workflows):
    return catalogue.build_catalogue(frame(spark, [document(*workflows)]))


def routed_of(cat, *overrides):
    return catalogue.routed_nodes(catalogue.in_run_order(cat), *overrides)


def test_weather(spark):
    cat = built(spark, weather())
    # the node without id is left out
    assert rows(cat.nodes.select("node_id")) == [("audit",), ("clean",), ("early",), ("fetch",), ("late",)]
    routed = routed_of(cat)
    levels = {r.node_id: r.level for r in routed.collect()}
    assert levels == {"fetch": 0, "audit": 0, "clean": 1, "early": 1, "late": 2}
    # both write rain: the one that runs first is deployed, though it is listed later
    models = {r.table_name: (r.node_id, r.body) for r in catalogue.deployable_models(routed).collect()}
    assert {t: n for t, (n, _) in models.items()} == {"rain": "early", "cleaned": "clean", "cleaned_copy": "clean"}
    assert models["rain"][1].startswith("SELECT place, mm FROM gauges")
    assert rows(catalogue.left_out_writers(routed)) == [("weather", "late", "rain", "early")]
    assert rows(catalogue.declarations(routed).select("table_name")) == [("gauges",), ("raw",)]
    found = {(r.node_id, r.kind, r.detail) for r in catalogue.review_items(cat).collect()}
    assert found == {
        ("late", "directive", "SET"), ("late", "duplicate", "rain has early"), ("early", "function", "LATERAL"),
        ("early", "function", "EXPLODE"),
        ("fetch", "triage", "Shell script -> BashOperator or PythonOperator; audit each"),
        ("audit", "not_auto", "PythonOperator"),
    }
    assert {r.schedule for r in catalogue.migration_matrix(cat).collect()} == {"15 04 * * *"}


def test_library(spark):
    cat = built(spark, library())
    routed = routed_of(cat)
    assert rows(catalogue.deployable_models(routed).select("table_name")) == [("loans",), ("returns",), ("shelf",)]
    assert rows(catalogue.declarations(routed).select("table_name")) == [("box_log",), ("desk_log",)]
    kinds = {r.kind: r.n for r in catalogue.review_items(cat).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"partition": 3, "not_auto": 2}
    stuck = routed.where("level > 100").select("node_id")
    assert rows(stuck) == [("below",), ("ring_a",), ("ring_b",)]
    registry = {r.name: (r.type, r.value) for r in catalogue.variable_registry(cat.variables).collect()}
    assert registry == {"bizdate": ("System", "19700101"), "branch": ("Custom", "east")}


def test_matrix_has_the_classifier_profile(spark):
    wf = workflow("w", [
        node("a", "PYODPS", "o2o.execute('x')"),
        node("b", "ODPS_SPARK", "main"),
        node("c", "PYTHON", "frame.groupby('k')"),
        node("d", "NEW_KIND", "x"),
        node("e", "PYTHON", "\n  Select 1"),
    ], flow=[])
    cat = built(spark, wf)
    planning = {r.node_id: r.gcp_target for r in catalogue.migration_matrix(cat).collect()}
    assert planning == {"a": "Dataform .sqlx", "b": "Dataproc (PySpark)", "c": "Dataflow (Beam)",
                        "d": "PythonOperator (review)", "e": "Dataform .sqlx"}
    build = {r.node_id: (r.target, r.reason) for r in catalogue.routed_nodes(cat.nodes).collect()}
    assert build["a"][0] == "Dataflow (Beam)"
    assert build["b"][0] == "TRIAGE"
    assert build["d"] == ("TRIAGE", "Unknown command -> human review")


def test_document_shapes(spark):
    a, b, c = node("a", "ODPS_SQL"), node("b", "PYODPS"), node("c", "VIRTUAL")
    docs = frame(spark, [
        a,
        {"spec": {"name": "list", "id": "l", "nodes": [b]}},
        document(workflow("first", [c]), workflow("second", [node("d", "VIRTUAL")])),
        {"id": "e", "workflow_id": "77", "name": "e", "spec": node("e", "PYTHON")},
        {"id": "f", "workflow_id": "77", "name": "f", "spec": {"spec": {"nodes": [node("f", "PYTHON"), node("", "PYTHON")]}}},
        {"spec": {"name": "none", "workflows": []}},
    ])
    found = [(r.workflow_id, r.workflow_name, r.i) for r in normalise(docs).select("workflow_id", "workflow_name", F.col("node.id").alias("i")).collect()]
    assert sorted(found, key=str) == sorted([
        (None, None, "a"), ("l", "list", "b"), ("first", "first", "c"),
        ("77", "workflow_77", "e"), ("77", "workflow_77", "f"),
    ], key=str)
    both = {**document(workflow("w", [b])), "spec": {"id": "s", "name": "s", "nodes": [a], "workflows": [workflow("w", [b]), workflow("v", [c])]}}
    first = {r.node.id for r in normalise(frame(spark, [both])).collect()}
    union = {r.node.id for r in normalise(frame(spark, [both]), "union").collect()}
    flows = {r.node.id for r in normalise(frame(spark, [both]), "workflows").collect()}
    assert (first, union, flows) == ({"a"}, {"a", "b", "c"}, {"b", "c"})


def test_flat_shape_and_landed_nodes(spark):
    a, b = node("a", "VIRTUAL"), node("b", "PYTHON", "print(1)", after=["a"])
    flat = {"spec": {"name": "flat", "id": "f", "nodes": [a, b], "flow": flow_of([a, b]), "trigger": {"cron": "00 05 06 * * ?"}}}
    landed = [{"id": n["id"], "workflow_id": "9", "name": n["name"], "spec": n} for n in (a, b, b)]
    cat = catalogue.build_catalogue(frame(spark, [flat, *landed]))
    assert rows(cat.workflows.select("workflow_id", "workflow_name", "cron")) == [
        ("9", "workflow_9", "00 02 00 * * ?"), ("f", "flat", "00 05 06 * * ?")]
    assert rows(cat.edges.select("workflow_id", "node_id", "upstream_id").distinct()) == [("9", "b", "a"), ("f", "b", "a")]
    assert cat.nodes.where("workflow_id = '9'").count() == 3
    assert rows(catalogue.unique_nodes(cat.nodes).select("workflow_id", "node_id")) == [
        ("9", "a"), ("9", "b"), ("f", "a"), ("f", "b")]


def test_scan_files(spark, tmp_path):
    for wf in (weather(), library()):
        (tmp_path / f"workflow_{wf['name']}.json").write_text(json.dumps(document(wf), indent=2))
    docs = scan_documents(spark, str(tmp_path / "*.json"))
    found = catalogue.flat_nodes(docs).groupBy("source_file").count()
    assert rows(found) == [("workflow_library.json", 7), ("workflow_weather.json", 5)]


OVERRIDES = "line int, node_id string, gcp_target string, review_notes string, skip string"


def test_overrides(spark):
    cat = built(spark, library())
    given = [
        (1, "left", "", "", "TRUE "), (2, "right", "TRIAGE", "look", ""), (3, "bottom", "Dataform .sqlx", "", "no"),
        (4, "ring_b", "PythonOperator", " ", ""),
    ]
    overrides = spark.createDataFrame(given, OVERRIDES)
    routed = {r.node_id: r for r in catalogue.routed_nodes(cat.nodes, overrides, ["line"]).collect()}
    assert routed["left"].skipped and not routed["bottom"].skipped
    assert (routed["right"].target, routed["right"].reason) == ("TRIAGE", "set by hand to TRIAGE")
    # an override that repeats the automatic value is none
    assert routed["bottom"].reason == "ODPS_SQL"
    assert routed["ring_b"].reason == "Lightweight procedural Python in Composer"
    items = {(r.node_id, r.kind) for r in catalogue.review_items(cat, overrides, override_order=["line"]).collect()}
    assert {("left", "skipped"), ("right", "triage"), ("right", "note")} <= items
    assert ("left", "partition") not in items
    with pytest.raises(ValueError):
        catalogue.routed_nodes(cat.nodes, overrides)


def test_last_override_row_counts(spark):
    cat = built(spark, weather())
    given = [(1, "late", "TRIAGE", "", "true"), (2, "late", "", "kept", "")]
    overrides = spark.createDataFrame(given, OVERRIDES)
    routed = catalogue.routed_nodes(cat.nodes, overrides, ["line"])
    assert routed.count() == 5
    row = routed.where("node_id = 'late'").first()
    assert (row.target, row.note, row.skipped) == ("Dataform .sqlx", "kept", False)
    kind = "line int, node_id string, schedule string"
    schedules = spark.createDataFrame([(1, "clean", " "), (2, "late", " 1 2 * * * "), (3, "early", "9 9 * * *")], kind)
    assert rows(catalogue.workflow_schedules(cat, schedules, ["line"])) == [("weather", "1 2 * * *")]
    assert rows(catalogue.workflow_schedules(cat, schedules.limit(1), ["line"])) == [("weather", "15 04 * * *")]
    # the last row of a node replaces its first before the first of the workflow is taken
    again = spark.createDataFrame([(1, "late", "1 1 * * *"), (2, "late", "2 2 * * *")], kind)
    assert rows(catalogue.workflow_schedules(cat, again, ["line"])) == [("weather", "2 2 * * *")]


def test_review_kinds(spark):
    insert = "INSERT INTO TABLE t SELECT NVL(a, 0), DATEADD(b, 1), rank FROM x WHERE c = '${gone}' AND d = '$[cyctime-1]';"
    wf = workflow("w", [
        node("ddl", "ODPS_SQL", "CREATE TABLE lonely (a INT);"),
        node("own", "ODPS_SQL", "CREATE TABLE t (a INT);"),
        node("none", "ODPS_SQL", insert),
        node("one", "ODPS_SQL", insert, writes=["p.q.t"]),
        node("two", "ODPS_SQL", insert, writes=["p.r.t"]),
        node("flag", "VIRTUAL", crossCycleDependsOnOtherNode=True),
        node("out", "VIRTUAL", inputs={"nodeOutputs": [{"data": "x1", "externalWorkflowId": "other"}]}),
    ], variables=(("cyctime", "System", ""),), flow=[{"nodeId": "one", "depends": [{"nodeId": "ddl", "type": "CrossCycle"}]}])
    found = {(r.node_id, r.kind, r.detail) for r in catalogue.review_items(built(spark, wf)).collect()}
    per_model = {("function", "DATEADD"), ("reserved", "rank"), ("unresolved", "gone"), ("offset_not_allowed", "cyctime")}
    assert found == {
        ("ddl", "ddl_only", "lonely"), ("none", "no_output", ""), ("one", "duplicate", "t has two"),
        ("one", "cross_cycle", "ODPS_SQL"), ("flag", "cross_cycle", "VIRTUAL"), ("", "cross_workflow", "other"),
    } | {(n, k, d) for n in ("one", "two") for k, d in per_model}


def test_duplicates_across_workflows(spark):
    one = workflow("a", [node("x", "ODPS_SQL", "INSERT INTO TABLE t SELECT 1;", writes=["p.t"])])
    two = workflow("b", [node("y", "ODPS_SQL", "INSERT INTO TABLE t SELECT 2;", writes=["p.t"])])
    both = built(spark, one, two)
    routed = routed_of(both)
    assert catalogue.deployable_models(routed).count() == 2
    assert rows(catalogue.deployable_models(routed, scope=()).select("node_id")) == [("x",)]
    found = rows(catalogue.review_items(both, scope=()).select("workflow_id", "node_id", "kind"))
    assert found == [("b", "y", "duplicate")]


def test_external_and_past(spark):
    wf = workflow("w", [
        node("a", "VIRTUAL", inputs={"nodeOutputs": [{"data": "d", "externalWorkflowId": "o", "externalNodeId": "n"}]}),
        node("b", "VIRTUAL", inputs={"nodeOutputs": [{"data": "d", "externalWorkflowId": "o"}, {"data": "a", "crossCycleDependsOnOtherNode": True}]}),
    ], flow=[])
    cat = built(spark, wf, )
    assert rows(catalogue.cross_workflow_deps(cat.nodes)) == [("w", "a", "o", "n"), ("w", "b", "o", "d")]
    assert rows(catalogue.cross_cycle_nodes(cat)) == [("w", "b")]
    assert rows(catalogue.depends_on_past(cat)) == [("w", True)]
    assert rows(catalogue.reference_flow(cat.nodes)) == [("w", "a", "d"), ("w", "b", "a"), ("w", "b", "d")]


def test_renest_keeps_every_node_in_bounded_parts(spark):
    nodes = [node(f"n{i:03d}", "VIRTUAL", after=[f"n{i - 1:03d}"] if i else []) for i in range(40)]
    cat = catalogue.build_catalogue(frame(spark, [document(workflow("big", nodes)), document(weather())]))
    nested = catalogue.renest(cat.nodes, 7)
    texts = nested.select(F.concat_ws("_", "workflow_id", "part").alias("f"), F.to_json(F.struct("kind", "spec")).alias("v"), F.size(F.col("spec.workflows")[0]["nodes"]).alias("n"))
    assert texts.agg(F.max("n")).first()[0] <= 7
    assert nested.where("workflow_id = 'weather'").count() == 1  # small workflows are never cut
    again = catalogue.build_catalogue(parse_documents(texts, "v", "f"))
    assert rows(again.nodes.select("workflow_id", "node_id")) == rows(cat.nodes.select("workflow_id", "node_id"))
    assert rows(again.edges.select("node_id", "upstream_id")) == rows(cat.edges.select("node_id", "upstream_id"))


def test_workflow_parity(spark):
    heads = "workflow_id string, schedule string, n_nodes long"
    source = spark.createDataFrame([("same", "02 00 * * *", 2), ("late", "00 02 00 * * *", 1), ("gap", "1 0 * * *", 1)], heads)
    made = spark.createDataFrame([("same", "02 00 * * *", 1), ("late", "03 00 * * *", 1), ("gap", "1 0 * * *", 1)], "workflow_id string, schedule string, n_models long")
    out = "workflow_id string, table_name string"
    sources = spark.createDataFrame([("same", "a"), ("gap", "b"), ("gap", "c")], out)
    builts = spark.createDataFrame([("same", "a"), ("gap", "b"), ("gap", "x")], out)
    loops = spark.createDataFrame([("gap",)], "workflow_id string")
    found = {r.workflow_id: (r.ok, r.detail) for r in catalogue.workflow_parity(source, made, sources, builts, loops).collect()}
    assert found["same"] == (True, "no difference")
    assert found["late"][1] == "schedule differs"
    assert found["gap"][1] == "1 outputs not built, 1 outputs without source, models depend on each other in a circle"
    assert rows(catalogue.output_issues(sources, builts)) == [("gap", "c", "missing"), ("gap", "x", "extra")]


def test_two_node_cycle(spark):
    wf = workflow("w", [node("a", "VIRTUAL", after=["b"]), node("b", "VIRTUAL", after=["a"])])
    cat = built(spark, wf)
    nodes = cat.nodes.select("workflow_id", F.col("node_id").alias("node"))
    edges = cat.edges.select("workflow_id", F.col("node_id").alias("node"), F.col("upstream_id").alias("upstream"))
    assert rows(graph.cyclic_nodes(nodes, edges, ["workflow_id"])) == [("w", "a", True), ("w", "b", True)]
    assert flow_of(wf["nodes"]) == wf["flow"]


def test_selector_and_fallback(spark):
    flows = spark.createDataFrame([("alpha", "1"), ("beta", "2"), ("3", "alpha")], "name string, id string")
    entries = spark.createDataFrame([("alpha",), ("2",), ("nobody",), ("",)], "entry string")
    assert rows(joins.keep_selected(flows, entries, "entry", "name", "id")) == [("3", "alpha"), ("alpha", "1"), ("beta", "2")]
    assert rows(joins.unmatched_entries(flows, entries, "entry", "name", "id")) == [("nobody",)]
    a = spark.createDataFrame([("1", "w")], "k string, v string")
    b = spark.createDataFrame([("1", "n"), ("2", "n"), ("2", "m")], "k string, v string")
    assert rows(prefer_then_fallback(a, b, "k")) == [("1", "w"), ("2", "m"), ("2", "n")]
