"""Catalogue of workflow documents: flat tables, routing, models, reviews, parity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.names import blank_to_null, last_part
from weirstone.functions.rules import (
    REVIEW_TARGET,
    RESERVED_WORDS,
    SQL_TARGET,
    route_for_build,
    route_for_planning,
    type_parts,
)
from weirstone.functions.rundate import (
    DEFAULT_SCHEDULE,
    SYSTEM_PLACEHOLDER,
    five_field_schedule,
    last_five_fields,
)
from weirstone.operators import corpus
from weirstone.operators.graph import prune_edges, topological_levels
from weirstone.operators.keyed import first_non_blank, first_per_key, last_per_key, later_writers
from weirstone.operators.ordering import ordered_parts
from weirstone.operators.setops import membership
from weirstone.session import materialise
from weirstone.sources.documents import FLOW, NODE, TRIGGER, VARIABLE, normalise, workflow_headers


@dataclass(frozen=True)
class Catalogue:
    """Flat tables of a set of workflow documents."""

    workflows: DataFrame
    nodes: DataFrame
    edges: DataFrame
    variables: DataFrame

    def stored(self) -> Catalogue:
        """The same tables, written once; jobs that read them often parse no document again."""
        return Catalogue(
            materialise(self.workflows, "workflows"),
            materialise(self.nodes, "nodes"),
            materialise(self.edges, "edges"),
            materialise(self.variables, "variables"),
        )

    @property
    def table_io(self) -> DataFrame:
        return table_io(self.nodes)


def _guids(tables: Column) -> Column:
    names = F.transform(F.coalesce(tables, F.array().cast("array<struct<guid:string>>")), lambda t: t["guid"])
    return F.filter(names, lambda g: F.coalesce(g, F.lit("")) != "")


def flat_nodes(docs: DataFrame, shapes: str = "workflows") -> DataFrame:
    """One row per node with its fields side by side."""
    n = normalise(docs, shapes)
    refs = F.coalesce(F.col("node.inputs.nodeOutputs"), F.array().cast(f"array<{_ref_type()}>"))
    return n.select(
        "source_file",
        "workflow_id",
        "workflow_name",
        "landed",
        "workflow_pos",
        "node_pos",
        F.col("node.id").alias("node_id"),
        F.coalesce(F.col("node.name"), F.lit("")).alias("node_name"),
        F.coalesce(F.col("node.script.runtime.command"), F.lit("")).alias("command"),
        F.coalesce(F.col("node.script.content"), F.lit("")).alias("content"),
        _guids(F.col("node.inputs.tables")).alias("input_guids"),
        _guids(F.col("node.outputs.tables")).alias("output_guids"),
        refs.alias("refs"),
        (
            F.coalesce(F.col("node.crossCycleDependsOnOtherNode"), F.lit(False))
            | F.exists(refs, lambda r: F.coalesce(r["crossCycleDependsOnOtherNode"], F.lit(False)))
        ).alias("cross_cycle"),
        "node",
    )


def _ref_type() -> str:
    return (
        "struct<data:string,artifactType:string,externalWorkflowId:string,externalNodeId:string,"
        "crossCycleDependsOnOtherNode:boolean>"
    )


def build_catalogue(docs: DataFrame, shapes: str = "workflows") -> Catalogue:
    """Flatten documents of any shape.

    A workflow that arrives in several documents keeps its first header, and a
    workflow file comes before landed node files.  The edges of landed nodes
    come from their references.
    """
    wf = workflow_headers(docs)
    headers = wf.select(
        F.col("wf.id").alias("workflow_id"),
        "landed",
        "source_file",
        "workflow_pos",
        F.coalesce(F.col("wf.name"), F.lit("")).alias("workflow_name"),
        F.coalesce(F.col("wf.trigger.cron"), F.lit(DEFAULT_SCHEDULE)).alias("cron"),
        F.coalesce(F.col("wf.trigger.timezone"), F.lit("UTC")).alias("timezone"),
        F.col("wf.strategy.rerunTimes").alias("rerun_times"),
    )
    workflows = first_per_key(headers, ["workflow_id"], ["landed", "source_file", "workflow_pos"]).drop("landed")
    nodes = flat_nodes(docs, shapes)
    entries = wf.select(F.col("wf.id").alias("workflow_id"), F.explode("wf.flow").alias("f"))
    deps = entries.select("workflow_id", F.col("f.nodeId").alias("node_id"), F.explode("f.depends").alias("d"))
    upstream = F.coalesce(F.nullif(F.col("d.nodeId"), F.lit("")), F.col("d.data"))
    edges = deps.select(
        "workflow_id",
        "node_id",
        upstream.alias("upstream_id"),
        F.col("d.type").alias("type"),
        (
            F.coalesce(F.col("d.crossCycleDependsOnOtherNode"), F.lit(False))
            | F.coalesce(F.col("d.type") == "CrossCycle", F.lit(False))
        ).alias("cross_cycle"),
    ).where(F.coalesce(F.col("upstream_id"), F.lit("")) != "")
    rebuilt = reference_flow(nodes.where("landed")).select(
        "workflow_id", "node_id", "upstream_id", F.lit("Normal").alias("type"), F.lit(False).alias("cross_cycle")
    )
    variables = (
        wf.select(
            "source_file", "workflow_pos", F.col("wf.id").alias("workflow_id"),
            F.posexplode("wf.variables").alias("variable_pos", "v"),
        )
        .select("source_file", "workflow_pos", "variable_pos", "workflow_id", "v.name", "v.type", "v.value")
        .where(F.coalesce(F.col("name"), F.lit("")) != "")
    )
    return Catalogue(workflows, nodes, edges.unionByName(rebuilt), variables)


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """One row per workflow and node id: the first in document order."""
    return first_per_key(nodes, ["workflow_id", "node_id"], ["source_file", "workflow_pos", "node_pos"])


def table_io(nodes: DataFrame) -> DataFrame:
    """Tables per node and direction: full id and last name part."""

    def side(col: str, direction: str) -> Column:
        return F.transform(F.col(col), lambda g: F.struct(F.lit(direction).alias("direction"), g.alias("guid")))

    rows = F.concat(side("input_guids", "read"), side("output_guids", "write"))
    flat = nodes.select("workflow_id", "node_id", F.inline(rows))
    return flat.withColumn("table_name", last_part(F.col("guid")))


def reference_flow(nodes: DataFrame) -> DataFrame:
    """Edges rebuilt from the upstream references of each node."""
    ups = F.transform(F.col("refs"), lambda r: r["data"])
    flat = nodes.select("workflow_id", "node_id", F.explode(ups).alias("upstream_id"))
    return flat.where(F.coalesce(F.col("upstream_id"), F.lit("")) != "")


def _names(guids: str) -> Column:
    return F.array_join(F.transform(F.col(guids), lambda g: last_part(g)), ",")


def migration_matrix(cat: Catalogue) -> DataFrame:
    """The planning table: one row per node, ten columns."""
    target, _ = route_for_planning(F.col("command"), F.col("content"))
    rows = cat.nodes.select(
        "workflow_id", "node_id", "node_name", "command",
        _names("input_guids").alias("input_tables"),
        _names("output_guids").alias("output_tables"),
        target.alias("gcp_target"),
    )
    schedule = five_field_schedule(F.coalesce(F.col("cron"), F.lit(DEFAULT_SCHEDULE)))
    heads = cat.workflows.select("workflow_id", "workflow_name", schedule.alias("schedule"))
    joined = rows.join(heads, "workflow_id", "left")
    return joined.select(
        F.coalesce(F.col("workflow_name"), F.lit("")).alias("workflow"),
        "node_id", "node_name", "command", "input_tables", "output_tables",
        F.coalesce(F.col("schedule"), five_field_schedule(F.lit(DEFAULT_SCHEDULE))).alias("schedule"),
        "gcp_target",
        F.lit("").alias("review_notes"),
        F.lit("").alias("skip"),
    )


def routed_nodes(
    nodes: DataFrame, overrides: DataFrame | None = None, override_order: Sequence[str] = ()
) -> DataFrame:
    """Nodes with target, reason, note and skip mark; a human target wins.

    ``overrides`` has ``gcp_target``, ``review_notes`` and ``skip`` per node id and
    the columns of ``override_order``, the order of the file: the last row of a
    node id counts.  A target that repeats the automatic one is no override.
    """
    auto_target, auto_reason = route_for_build(F.col("command"), F.col("content"))
    rows = nodes.withColumns({"auto_target": auto_target, "auto_reason": auto_reason})
    if overrides is None:
        empty = F.lit(None).cast("string")
        rows = rows.withColumns({"_t": empty, "note": empty, "_s": empty})
    else:
        if not override_order:
            raise ValueError("overrides need the order of their file")
        columns = ["node_id", *override_order, "gcp_target", "review_notes", "skip"]
        marks = last_per_key(overrides, ["node_id"], override_order, columns).select(
            "node_id",
            blank_to_null(F.col("gcp_target")).alias("_t"),
            blank_to_null(F.col("review_notes")).alias("note"),
            F.col("skip").alias("_s"),
        )
        rows = rows.join(marks, "node_id", "left")
    changed = F.col("_t").isNotNull() & (F.col("_t") != F.col("auto_target"))
    return rows.withColumns(
        {
            "target": F.coalesce(F.col("_t"), F.col("auto_target")),
            "reason": F.when(changed, F.concat(F.lit("set by hand to "), F.col("_t"))).otherwise(F.col("auto_reason")),
            "skipped": F.coalesce(F.lower(F.trim(F.col("_s"))) == "true", F.lit(False)),
        }
    ).drop("_t", "_s", "auto_target", "auto_reason")


def workflow_schedules(cat: Catalogue, overrides: DataFrame, order: Sequence[str]) -> DataFrame:
    """Five-field schedule per workflow: the first non-blank override of any of its
    nodes in the order of the override file, else its own.  The last row of a node counts."""
    owners = cat.nodes.select("workflow_id", "node_id").distinct()
    given = owners.join(last_per_key(overrides, ["node_id"], order, ["node_id", *order, "schedule"]), "node_id")
    chosen = first_non_blank(given, ["workflow_id"], order, "schedule", "_given")
    own = five_field_schedule(F.col("cron"))
    rows = cat.workflows.select("workflow_id", own.alias("_own")).join(chosen, "workflow_id", "left")
    return rows.select("workflow_id", F.coalesce(F.trim("_given"), F.col("_own")).alias("schedule"))


ORDER = ("source_file", "workflow_pos", "node_pos", "node_id")
# Execution order: workflows as they come, then levels of their flow; ties by document order.
RUN_ORDER = ("workflow_first", "level", *ORDER)
_NO_LEVEL = 1 << 62


def in_run_order(cat: Catalogue) -> DataFrame:
    """The nodes with ``workflow_first`` and ``level``, the columns that ``RUN_ORDER`` needs.

    Nodes on or below a cycle have no level and come last.
    """
    group = ["workflow_id"]
    ids = cat.nodes.select("workflow_id", F.col("node_id").alias("node"))
    edges = cat.edges.select("workflow_id", F.col("node_id").alias("node"), F.col("upstream_id").alias("upstream"))
    levels = topological_levels(ids, edges, group).withColumnRenamed("node", "node_id")
    first = cat.nodes.groupBy("workflow_id").agg(F.min("source_file").alias("workflow_first"))
    rows = cat.nodes.join(levels, ["workflow_id", "node_id"], "left").join(first, "workflow_id", "left")
    return rows.withColumn("level", F.coalesce("level", F.lit(_NO_LEVEL)))


def model_candidates(routed: DataFrame) -> DataFrame:
    """SQL nodes with a query body and an output: one row per node and output table."""
    body = corpus.insert_body(corpus.clean_script(F.col("content")))
    sql = routed.where((F.col("target") == SQL_TARGET) & (F.col("command") != "VIRTUAL") & ~F.col("skipped"))
    placed = [c for c in RUN_ORDER if c in routed.columns]
    rows = sql.select(
        "workflow_id", "workflow_name", *placed, "node_name", body.alias("body"),
        F.explode("output_guids").alias("guid"),
    ).where(F.col("body") != "")
    return rows.withColumn("table_name", last_part(F.col("guid")))


def deployable_models(
    routed: DataFrame, scope: Sequence[str] = ("workflow_id",), order: Sequence[str] = RUN_ORDER
) -> DataFrame:
    """One model per output table within a scope: the first writer in execution order is deployed.

    ``routed`` comes from the nodes of ``in_run_order``.
    """
    return first_per_key(model_candidates(routed), [*scope, "table_name"], order)


def left_out_writers(
    routed: DataFrame, scope: Sequence[str] = (), order: Sequence[str] = RUN_ORDER
) -> DataFrame:
    """Every writer of an output table but the first, with the id of the winner."""
    models = model_candidates(routed)
    rows = models.select(*dict.fromkeys(["workflow_id", *scope, *order, "table_name"]))
    return later_writers(rows, [*scope, "table_name"], order).select("workflow_id", "node_id", "table_name", "winner_node_id")


def declarations(routed: DataFrame, scope: Sequence[str] = ("workflow_id",)) -> DataFrame:
    """Tables that models read and nothing in the scope produces."""
    body = corpus.insert_body(corpus.clean_script(F.col("content")))
    writers = routed.where(body != "")
    produced = writers.select(*scope, F.explode("output_guids").alias("g")).select(
        *scope, last_part(F.col("g")).alias("table_name")
    )
    models = model_candidates(routed).select("node_id", *scope).distinct()
    reads = routed.select(*scope, "node_id", F.explode("input_guids").alias("g")).join(
        models, [*scope, "node_id"], "left_semi"
    )
    reads = reads.select(*scope, last_part(F.col("g")).alias("table_name"))
    sides = membership(reads, produced, [*scope, "table_name"])
    return sides.where(F.col("in_left") & ~F.col("in_right")).select(*scope, "table_name")


def cross_cycle_nodes(cat: Catalogue) -> DataFrame:
    """Distinct nodes that depend on an earlier cycle: marked on the node, on one
    of its references, or on an edge."""
    marked = cat.nodes.where("cross_cycle").select("workflow_id", "node_id")
    by_edge = cat.edges.where("cross_cycle").select("workflow_id", "node_id")
    return marked.unionByName(by_edge).distinct()


def depends_on_past(cat: Catalogue) -> DataFrame:
    """Per workflow: does any node depend on an earlier cycle."""
    return cat.workflows.select("workflow_id").join(
        cross_cycle_nodes(cat).select("workflow_id").distinct().withColumn("depends_on_past", F.lit(True)),
        "workflow_id", "left",
    ).withColumn("depends_on_past", F.coalesce(F.col("depends_on_past"), F.lit(False)))


def cross_workflow_deps(nodes: DataFrame) -> DataFrame:
    """References of nodes to nodes of other workflows."""
    flat = nodes.select("workflow_id", "node_id", F.explode("refs").alias("r"))
    return flat.where(F.coalesce(F.col("r.externalWorkflowId"), F.lit("")) != "").select(
        "workflow_id",
        "node_id",
        F.col("r.externalWorkflowId").alias("external_workflow_id"),
        F.coalesce(F.nullif(F.col("r.externalNodeId"), F.lit("")), F.col("r.data")).alias("external_node_id"),
    )


def review_items(
    cat: Catalogue,
    overrides: DataFrame | None = None,
    scope: Sequence[str] = (),
    override_order: Sequence[str] = (),
) -> DataFrame:
    """Everything a person must look at: workflow, node, kind, detail; one row per finding.

    One pass over the documents routes the nodes and writes them as columns;
    each kind of finding then reads only the columns it needs.  ``scope`` is
    where one writer per table is allowed: the project, or each workflow.
    """
    cat = cat.stored()
    routed = routed_nodes(in_run_order(cat), overrides, override_order)
    facts = _node_facts(materialise(_routed_columns(routed), "review"))
    extra = [] if "workflow_id" in scope else ["workflow_id"]
    outputs = facts.where("has_body").select(*scope, F.explode("outputs").alias("detail"))
    no_body = facts.where("ddl_only").select(
        *scope, *extra, "node_id", F.lit("ddl_only").alias("kind"), F.coalesce("created", F.lit("?")).alias("detail")
    )
    ddl = no_body.join(outputs.distinct(), [*scope, "detail"], "left_anti")
    past = (
        facts.where("live")
        .select("workflow_id", "node_id", F.lit("cross_cycle").alias("kind"), F.col("command").alias("detail"))
        .join(cross_cycle_nodes(cat), ["workflow_id", "node_id"], "left_semi")
    )
    uses = facts.select("workflow_id", "node_id", F.inline("uses"))
    variables = corpus.variable_status(uses, cat.variables.select("workflow_id", "name"), ["workflow_id"])
    variables = variables.where(F.col("status") != "resolved").select(
        "workflow_id", "node_id", F.col("status").alias("kind"), F.col("name").alias("detail")
    )
    writers = facts.where("model").select("workflow_id", *RUN_ORDER, F.explode("outputs").alias("table_name"))
    later = later_writers(writers, [*scope, "table_name"], RUN_ORDER)
    duplicates = later.select(
        "workflow_id", "node_id", F.lit("duplicate").alias("kind"),
        F.concat("table_name", F.lit(" has "), "winner_node_id").alias("detail"),
    )
    outside = facts.select("workflow_id", F.explode("externals").alias("detail")).distinct()
    externals = outside.select("workflow_id", F.lit("").alias("node_id"), F.lit("cross_workflow").alias("kind"), "detail")
    found = facts.select("workflow_id", "node_id", F.inline("items")).where(F.col("detail").isNotNull())
    for part in (ddl, past, variables, duplicates, externals):
        found = found.unionByName(part.select("workflow_id", "node_id", "kind", "detail"))
    return found


def _routed_columns(routed: DataFrame) -> DataFrame:
    outside = F.transform("refs", lambda r: r["externalWorkflowId"])
    clean = corpus.clean_script(F.col("content"))
    return routed.select(
        "workflow_id",
        *RUN_ORDER,
        "command",
        "target",
        "reason",
        "note",
        (~F.col("skipped")).alias("live"),
        corpus.insert_body(clean).alias("body"),
        corpus.directives(F.col("content")).alias("directives"),
        corpus.partition_column(clean).alias("partition_column"),
        last_part(corpus.created_table(clean)).alias("created"),
        F.transform("output_guids", lambda g: last_part(g)).alias("outputs"),
        F.filter(outside, lambda x: F.coalesce(x, F.lit("")) != "").alias("externals"),
    )


def _node_facts(routed: DataFrame) -> DataFrame:
    """What each node alone tells: marks, variable uses and findings."""
    live, body = F.col("live"), F.col("body")
    virtual = F.col("command") == "VIRTUAL"
    triage = F.col("target") == REVIEW_TARGET
    sql = (F.col("target") == SQL_TARGET) & ~virtual
    has_body = body != ""
    has_output = F.size("outputs") > 0
    model = live & sql & has_body & has_output
    identifiers = F.regexp_extract_all(F.lower(body), F.lit(r"\b([a-z_][a-z0-9_]*)\b"), F.lit(1))

    def listed(words: Sequence[str]) -> Column:
        return F.array(*[F.lit(w) for w in words])

    def items(condition: Column, kind: str, details: Column) -> Column:
        entry = F.transform(details, lambda d: F.struct(F.lit(kind).alias("kind"), d.alias("detail")))
        return F.when(F.coalesce(condition, F.lit(False)), entry).otherwise(_no_items())

    def item(condition: Column, kind: str, detail: Column) -> Column:
        entry = F.array(F.struct(F.lit(kind).alias("kind"), detail.alias("detail")))
        return F.when(F.coalesce(condition, F.lit(False)), entry).otherwise(_no_items())

    found = F.concat(
        item(~live, "skipped", F.col("command")),
        item(live & ~virtual & triage, "triage", F.col("reason")),
        item(live & ~virtual & ~triage & ~sql, "not_auto", F.col("target")),
        item(live & sql & has_body & ~has_output, "no_output", F.lit("")),
        item(model, "partition", F.col("partition_column")),
        items(model, "function", corpus.reviewed_calls(body)),
        items(live & sql, "directive", F.col("directives")),
        items(model, "reserved", F.array_intersect(identifiers, listed(RESERVED_WORDS))),
        item(live & F.col("note").isNotNull(), "note", F.col("note")),
    )
    no_uses = F.array().cast("array<struct<form:string,name:string,day_offset:int>>")
    return routed.withColumns(
        {
            "model": model,
            "has_body": has_body,
            "ddl_only": live & sql & ~has_body,
            "uses": F.when(model, corpus.variable_use_list(body)).otherwise(no_uses),
            "items": found,
        }
    )


def _no_items() -> Column:
    return F.array().cast("array<struct<kind:string,detail:string>>")


def review_counts(items: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Findings per workflow, one column per kind."""
    return items.groupBy("workflow_id").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds]
    )


def variable_registry(variables: DataFrame) -> DataFrame:
    """One row per variable name: the first definition; system variables get a placeholder."""
    value = F.when(F.col("type") == "System", SYSTEM_PLACEHOLDER).otherwise(F.coalesce(F.col("value"), F.lit("")))
    rows = variables.withColumn("value", value)
    return first_per_key(rows, ["name"], ["source_file", "workflow_pos", "variable_pos"], ["name", "type", "value"] + ["source_file", "workflow_pos", "variable_pos"]).select("name", "type", "value")


def renest(nodes: DataFrame, size: int, headers: DataFrame | None = None) -> DataFrame:
    """Rebuild workflow documents from node rows, with the flow from node references.

    A workflow is one document, or several parts of at most ``size`` nodes;
    flattening the parts gives the same nodes again.  Of nodes with one id in a
    workflow the first in document order stays.  ``headers`` has one row per
    workflow with ``workflow_id`` and any of ``workflow_name``, ``trigger`` and
    ``variables``; they stand in every part, and what is missing is the name
    ``workflow_<id>``, an empty trigger and no variables.
    """
    once = unique_nodes(nodes.select("workflow_id", *ORDER, "node"))
    parts = ordered_parts(once, "workflow_id", list(ORDER), size, unique=True)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_rank", "node"))), lambda r: r["node"])
    grouped = parts.groupBy("workflow_id", "part").agg(listed.alias("nodes"))
    none = F.lit(None)
    given = {"workflow_name": "string", "trigger": TRIGGER, "variables": f"array<{VARIABLE}>"}
    if headers is None:
        grouped = grouped.withColumns({c: none.cast(kind) for c, kind in given.items()})
    else:
        known = [F.col(c) if c in headers.columns else none.cast(k).alias(c) for c, k in given.items()]
        grouped = grouped.join(headers.select("workflow_id", *known), "workflow_id", "left")

    def flow_of(node: Column) -> Column:
        refs = F.filter(
            F.coalesce(node["inputs"]["nodeOutputs"], F.array().cast(f"array<{_ref_type()}>")),
            lambda r: F.coalesce(r["data"], F.lit("")) != "",
        )
        depends = F.transform(
            refs,
            lambda r: F.struct(
                r["data"].alias("nodeId"),
                none.cast("string").alias("data"),
                F.lit("Normal").alias("type"),
                none.cast("boolean").alias("crossCycleDependsOnOtherNode"),
            ),
        )
        return F.struct(node["id"].alias("nodeId"), depends.alias("depends"))

    name = F.coalesce("workflow_name", F.concat(F.lit("workflow_"), F.col("workflow_id")))
    empty = F.from_json(F.lit("{}"), TRIGGER)
    workflow = F.struct(
        F.col("workflow_id").alias("id"),
        name.alias("name"),
        F.coalesce("trigger", empty).alias("trigger"),
        F.coalesce("variables", F.array().cast(given["variables"])).alias("variables"),
        F.col("nodes").cast(f"array<{NODE}>").alias("nodes"),
        F.transform("nodes", flow_of).cast(f"array<{FLOW}>").alias("flow"),
    )
    kind = F.lit("CycleWorkflow")
    return grouped.select(
        "workflow_id",
        "part",
        F.struct(F.col("workflow_id").alias("uuid")).alias("metadata"),
        kind.alias("kind"),
        F.lit("1.1.0").alias("version"),
        F.struct(
            name.alias("name"), F.col("workflow_id").alias("id"), kind.alias("type"), F.array(workflow).alias("workflows")
        ).alias("spec"),
    )


def document_headers(cat: Catalogue) -> DataFrame:
    """Headers for ``renest``: name, trigger and the first definition of each variable of a workflow."""
    order = ["source_file", "workflow_pos", "variable_pos"]
    first = first_per_key(cat.variables, ["workflow_id", "name"], order)
    none = F.lit(None).cast("string")
    variable = F.struct(none.alias("id"), "name", none.alias("scope"), "type", "value")
    listed = F.transform(F.sort_array(F.collect_list(F.struct(*order, variable.alias("v")))), lambda r: r["v"])
    variables = first.groupBy("workflow_id").agg(listed.cast(f"array<{VARIABLE}>").alias("variables"))
    trigger = F.struct(
        F.lit("Scheduler").alias("type"), "cron", none.alias("startTime"), none.alias("endTime"), "timezone"
    )
    heads = cat.workflows.select("workflow_id", "workflow_name", trigger.cast(TRIGGER).alias("trigger"))
    return heads.join(variables, "workflow_id", "left")


def column_catalogue(metadata: DataFrame) -> DataFrame:
    """Columns of tables with collapsed type, Spark type, comment and unknown-type flag.

    ``metadata`` has ``guid`` and ``columns`` (name, type, comment).
    """
    flat = metadata.select("guid", F.posexplode("columns").alias("column_pos", "c"))
    typed = flat.withColumn("parts", type_parts(F.col("c.type")))
    return typed.select(
        "guid",
        "column_pos",
        F.col("c.name").alias("column_name"),
        F.col("c.type").alias("source_type"),
        F.col("parts.warehouse").alias("warehouse_type"),
        F.col("parts.spark").alias("spark_type"),
        F.col("parts.flagged").alias("flagged"),
        F.coalesce(F.col("c.comment"), F.lit("")).alias("comment"),
    )


def workflow_parity(
    source: DataFrame, built: DataFrame, source_outputs: DataFrame, built_outputs: DataFrame, cyclic: DataFrame
) -> DataFrame:
    """Per workflow: schedule, missing and extra outputs, cycles; verdict and issue text.

    ``source`` has ``workflow_id, schedule, n_nodes``, ``built`` has ``workflow_id,
    schedule, n_models``; outputs are ``workflow_id, table_name``; ``cyclic``
    lists ``workflow_id`` with a cycle.  The tables that differ are rows of
    ``output_issues``.
    """
    sides = membership(source_outputs, built_outputs, ["workflow_id", "table_name"])
    counts = sides.groupBy("workflow_id").agg(
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("n_missing"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("n_extra"),
    )
    loops = cyclic.select("workflow_id").distinct().withColumn("cyclic", F.lit(True))
    rows = (
        source.select("workflow_id", F.col("schedule").alias("source_schedule"), "n_nodes")
        .join(built.select("workflow_id", F.col("schedule").alias("built_schedule"), "n_models"), "workflow_id", "left")
        .join(counts, "workflow_id", "left")
        .join(loops, "workflow_id", "left")
        .na.fill(0, ["n_missing", "n_extra", "n_models"])
        .na.fill(False, ["cyclic"])
    )
    same = last_five_fields(F.col("source_schedule")).eqNullSafe(last_five_fields(F.col("built_schedule")))
    issues = F.concat_ws(
        ", ",
        F.when(~same, F.lit("schedule differs")),
        F.when(F.col("n_missing") > 0, F.concat("n_missing", F.lit(" outputs not built"))),
        F.when(F.col("n_extra") > 0, F.concat("n_extra", F.lit(" outputs without source"))),
        F.when(F.col("cyclic"), F.lit("models depend on each other in a circle")),
    )
    return rows.withColumn("ok", issues == "").withColumn(
        "detail", F.when(issues == "", "no difference").otherwise(issues)
    )


def model_links(models: DataFrame, scope: Sequence[str] = ("workflow_id",)) -> DataFrame:
    """Which deployed model reads which: ``node`` and ``upstream`` are output tables of one scope.

    ``models`` comes from ``deployable_models``; what a body reads is found in its text.
    """
    reads = corpus.table_references(models, [*scope, F.col("table_name").alias("node")], F.col("body"))
    edges = reads.withColumnRenamed("table_name", "upstream")
    known = prune_edges(models.select(*scope, F.col("table_name").alias("node")), edges, list(scope))
    return known.select(*scope, "node", "upstream")


def built_parity(cat: Catalogue, models: DataFrame, schedules: DataFrame) -> DataFrame:
    """``workflow_parity`` of a catalogue with what was built from it.

    ``models`` are its deployed models by workflow, ``schedules`` the schedules these
    run by; the cycles are those of models that read each other's tables.
    """
    group = ["workflow_id"]
    built = materialise(models.select(*group, "table_name", "body"), "models")
    heads = cat.workflows.select("workflow_id", five_field_schedule(F.col("cron")).alias("schedule"))
    sizes = cat.nodes.groupBy(*group).agg(F.count_if(F.col("command") != "VIRTUAL").alias("n_nodes"))
    source = heads.join(sizes, group, "left").na.fill(0, ["n_nodes"])
    counts = built.groupBy(*group).agg(F.count(F.lit(1)).alias("n_models"))
    target = schedules.select("workflow_id", "schedule").join(counts, group, "left").na.fill(0, ["n_models"])
    levels = topological_levels(built.select(*group, F.col("table_name").alias("node")), model_links(built), group)
    outputs = cat.table_io.where("direction = 'write'").select(*group, "table_name")
    return workflow_parity(source, target, outputs, built.select(*group, "table_name"), levels.where("level IS NULL"))


def output_issues(source_outputs: DataFrame, built_outputs: DataFrame) -> DataFrame:
    """Each missing or extra output table of a workflow as a row."""
    sides = membership(source_outputs, built_outputs, ["workflow_id", "table_name"])
    kind = F.when(F.col("in_left"), "missing").otherwise("extra")
    return sides.where(F.col("in_left") != F.col("in_right")).select("workflow_id", "table_name", kind.alias("kind"))
