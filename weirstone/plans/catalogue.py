"""Catalogue jobs over workflow documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirstone.functions.rules import HEAVY_MARKERS
from weirstone.functions.rundate import five_field_schedule
from weirstone.operators import catalogue, corpus, ordering
from weirstone.plans.conversation_documents import TURNS_SQL, document_texts, documents, mixed_shape_texts, turns
from weirstone.plans.registry import query, table
from weirstone.session import fresh_path
from weirstone.sources.documents import normalise, parse_documents, parse_with_rejects
from weirstone.sources.documents import scan_documents as scan

_TURNS = f"WITH t AS ({TURNS_SQL})"
_FIVE = "substr(replace(cron, '?', '*'), 4)"
_HEAVY = " OR ".join(f"contains(lower(content), '{m}')" for m in HEAVY_MARKERS)
_SQL_HEAD = r"regexp_matches(content, '(?i)^\s*(sql|select|insert)')"
# Target of a turn in each profile.
_PLAN_TARGET = f"""CASE command WHEN 'ODPS_SQL' THEN 'Dataform .sqlx' WHEN 'VIRTUAL' THEN 'EmptyOperator'
      WHEN 'DIDE_SHELL' THEN 'TRIAGE'
      ELSE CASE WHEN contains(lower(content), 'o2o') OR {_SQL_HEAD} THEN 'Dataform .sqlx'
                WHEN {_HEAVY} THEN 'Dataflow (Beam)' ELSE 'PythonOperator' END END"""
_BUILD_TARGET = f"""CASE command WHEN 'ODPS_SQL' THEN 'Dataform .sqlx' WHEN 'VIRTUAL' THEN 'EmptyOperator'
      WHEN 'DIDE_SHELL' THEN 'TRIAGE'
      ELSE CASE WHEN {_SQL_HEAD} THEN 'Dataform .sqlx'
                WHEN {_HEAVY} THEN 'Dataflow (Beam)' ELSE 'PythonOperator' END END"""
# The query that a write takes its rows from, in two steps.
_TAIL = rf"regexp_extract(content, '{corpus.WRITE_TAIL}', 1)"
_BODY = rf"regexp_replace(regexp_extract({_TAIL}, '{corpus.QUERY_TAIL}', 1), '[\s;]+$', '')"


def _catalogue(spark, sf):
    return catalogue.build_catalogue(documents(spark, sf))


@query("scan_documents", f"{_TURNS} SELECT workflow_id, node_id, command, TRUE AS has_file FROM t")
def scan_documents(spark, sf):
    path = fresh_path(spark, "documents")
    document_texts(spark, sf).select("value").write.text(path)
    docs = scan(spark, path, multi_line=False)
    return catalogue.flat_nodes(docs).select(
        "workflow_id", "node_id", "command", F.endswith("source_file", F.lit(".txt")).alias("has_file")
    )


@query(
    "document_rejects",
    f"""{_TURNS} SELECT source_file, (conv_id + turn) % 7 = 1 AS blank FROM t WHERE (conv_id + turn) % 7 < 2""",
)
def document_rejects(spark, sf):
    # Some documents are cut off, some are blank: both come out as rejects, the others as documents.
    number = F.try_to_number(F.split_part("source_file", F.lit("_"), F.lit(2)), F.lit("999999999999"))
    turn = F.try_to_number(F.regexp_extract("source_file", r"_(\d+)\.json$", 1), F.lit("999999999999"))
    kind = (number + turn) % 7
    texts = document_texts(spark, sf).withColumn(
        "value",
        F.when(kind == 0, F.expr("substr(value, 1, length(value) - 5)")).when(kind == 1, F.lit(" \n")).otherwise(F.col("value")),
    )
    return parse_with_rejects(texts, "value", "source_file")[1].select("source_file", (F.trim("value", F.lit(" \n")) == "").alias("blank"))


@query(
    "normalise_documents",
    f"""{_TURNS} SELECT workflow_id, CASE WHEN turn % 3 = 2 THEN 'workflow_' ELSE 'conv_' END || workflow_id AS workflow_name,
            node_id, command, content FROM t""",
)
def normalise_documents(spark, sf):
    docs = parse_documents(mixed_shape_texts(spark, sf), "value", "source_file")
    return normalise(docs).select(
        "workflow_id", "workflow_name", F.col("node.id").alias("node_id"),
        F.col("node.script.runtime.command").alias("command"), F.col("node.script.content").alias("content"),
    )


@query(
    "catalogue_workflows",
    f"{_TURNS} SELECT DISTINCT workflow_id, 'conv_' || workflow_id AS workflow_name, {_FIVE} AS schedule, 'UTC' AS timezone FROM t",
)
def catalogue_workflows(spark, sf):
    return _catalogue(spark, sf).workflows.select(
        "workflow_id", "workflow_name", five_field_schedule(F.col("cron")).alias("schedule"), "timezone"
    )


@query("catalogue_nodes", f"{_TURNS} SELECT workflow_id, node_id, 'turn_' || turn AS node_name, command, content FROM t")
def catalogue_nodes(spark, sf):
    return _catalogue(spark, sf).nodes.select("workflow_id", "node_id", "node_name", "command", "content")


@query(
    "catalogue_edges",
    f"""{_TURNS} SELECT workflow_id, node_id, before AS upstream_id, edge_flag AS cross_cycle FROM t WHERE turn > 0""",
)
def catalogue_edges(spark, sf):
    return _catalogue(spark, sf).edges.select("workflow_id", "node_id", "upstream_id", "cross_cycle")


@query(
    "catalogue_table_io",
    f"""{_TURNS} SELECT workflow_id, node_id, 'read' AS direction, input_guid AS guid, split_part(input_guid, '.', -1) AS table_name
        FROM t WHERE input_guid IS NOT NULL
        UNION ALL SELECT workflow_id, node_id, 'write', output_guid, split_part(output_guid, '.', -1)
        FROM t WHERE output_guid IS NOT NULL""",
)
def catalogue_table_io(spark, sf):
    return _catalogue(spark, sf).table_io


@query(
    "variable_registry",
    f"""{_TURNS}, v AS (
          SELECT source_file, 0 AS p, 'bizdate' AS name, 'System' AS type, '19700101' AS value FROM t
          UNION ALL SELECT source_file, 1, 'region', 'Custom', region FROM t
          UNION ALL SELECT source_file, 2, custom, 'Custom', node_id FROM t)
        SELECT name, arg_min(type, source_file) AS type, arg_min(value, source_file) AS value FROM v GROUP BY name""",
)
def variable_registry(spark, sf):
    return catalogue.variable_registry(_catalogue(spark, sf).variables)


@query(
    "migration_matrix",
    f"""{_TURNS} SELECT 'conv_' || workflow_id AS workflow, node_id, 'turn_' || turn AS node_name, command,
            COALESCE(split_part(input_guid, '.', -1), '') AS input_tables, COALESCE(split_part(output_guid, '.', -1), '') AS output_tables,
            {_FIVE} AS schedule, {_PLAN_TARGET} AS gcp_target, '' AS review_notes, '' AS skip FROM t""",
)
def migration_matrix(spark, sf):
    return catalogue.migration_matrix(_catalogue(spark, sf))


# Test overrides: skipped turns, notes, and targets set by hand.
_OVERRIDES = """SELECT CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) AS node_id, 2 AS line,
    CASE WHEN conv_id % 23 = 0 AND turn % 3 = 2 THEN 'TRIAGE' ELSE '' END AS gcp_target,
    CASE WHEN conv_id % 19 = 0 THEN 'check' ELSE ' ' END AS review_notes,
    CASE WHEN conv_id % 17 = 0 AND turn % 3 = 1 THEN ' TRUE' ELSE '' END AS skip
    FROM {conversations}"""


def _overrides(spark, sf):
    # every node has an earlier line in the file, which the later one replaces
    last = spark.sql(_OVERRIDES, conversations=table(spark, sf, "conversations"))
    early = last.select(
        "node_id", F.lit(1).alias("line"), F.lit("TRIAGE").alias("gcp_target"), F.lit("old").alias("review_notes"), F.lit("true").alias("skip")
    )
    return early.unionByName(last)


_ROUTED = f"""{_TURNS}, o AS ({_OVERRIDES.replace('{conversations}', 'conversations')}),
    r AS (SELECT t.*, {_BODY} AS body, {_BUILD_TARGET} AS auto_target,
                 COALESCE(lower(trim(o.skip)) = 'true', FALSE) AS skipped, nullif(trim(o.review_notes), '') AS note,
                 nullif(trim(o.gcp_target), '') AS given FROM t LEFT JOIN o ON t.node_id = o.node_id),
    n AS (SELECT *, COALESCE(given, auto_target) AS target, split_part(output_guid, '.', -1) AS out_table,
                 given IS NOT NULL AND given <> auto_target AS changed FROM r)"""


@query(
    "routed_nodes",
    f"{_ROUTED} SELECT workflow_id, node_id, target, skipped, note FROM n",
)
def routed_nodes(spark, sf):
    nodes = _catalogue(spark, sf).nodes
    return catalogue.routed_nodes(nodes, _overrides(spark, sf), ["line"]).select("workflow_id", "node_id", "target", "skipped", "note")


# Test overrides of the schedule, in file order.
_SCHEDULES = """SELECT CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING) AS node_id, conv_id, turn,
    CASE WHEN conv_id % 8 = 0 AND turn > 0 THEN ' ' || CAST(turn AS STRING) || ' 5 * * *' ELSE ' ' END AS schedule
    FROM {conversations}"""


@query(
    "workflow_schedules",
    f"""{_TURNS}, o AS ({_SCHEDULES.replace('{conversations}', 'conversations')}),
        g AS (SELECT t.workflow_id, arg_min(trim(o.schedule), o.turn) AS given FROM t JOIN o ON t.node_id = o.node_id
              WHERE trim(o.schedule) <> '' GROUP BY t.workflow_id)
        SELECT DISTINCT t.workflow_id, COALESCE(given, {_FIVE}) AS schedule FROM t LEFT JOIN g ON t.workflow_id = g.workflow_id""",
)
def workflow_schedules(spark, sf):
    overrides = spark.sql(_SCHEDULES, conversations=table(spark, sf, "conversations"))
    return catalogue.workflow_schedules(_catalogue(spark, sf), overrides, ["conv_id", "turn"])


@query(
    "deployable_models",
    f"""{_ROUTED} SELECT workflow_id, table_name, node_id, body FROM (
          SELECT workflow_id, out_table AS table_name, node_id, body,
                 row_number() OVER (PARTITION BY workflow_id, out_table ORDER BY turn, source_file) AS k FROM n
          WHERE NOT skipped AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NOT NULL) WHERE k = 1""",
)
def deployable_models(spark, sf):
    routed = catalogue.routed_nodes(catalogue.in_run_order(_catalogue(spark, sf).stored()), _overrides(spark, sf), ["line"])
    return catalogue.deployable_models(routed).select("workflow_id", "table_name", "node_id", "body")


@query(
    "project_models",
    f"""{_ROUTED} SELECT table_name, node_id FROM (
          SELECT out_table AS table_name, node_id, row_number() OVER (PARTITION BY out_table ORDER BY first_file, turn, source_file) AS k
          FROM (SELECT *, MIN(source_file) OVER (PARTITION BY workflow_id) AS first_file FROM n)
          WHERE NOT skipped AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NOT NULL) WHERE k = 1""",
)
def project_models(spark, sf):
    routed = catalogue.routed_nodes(catalogue.in_run_order(_catalogue(spark, sf).stored()), _overrides(spark, sf), ["line"])
    return catalogue.deployable_models(routed, scope=()).select("table_name", "node_id")


@query(
    "declarations",
    f"""{_ROUTED} SELECT DISTINCT workflow_id, split_part(input_guid, '.', -1) AS table_name FROM n
        WHERE NOT skipped AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NOT NULL
        EXCEPT SELECT workflow_id, out_table FROM n WHERE body <> ''""",
)
def declarations(spark, sf):
    routed = catalogue.routed_nodes(_catalogue(spark, sf).nodes, _overrides(spark, sf), ["line"])
    return catalogue.declarations(routed)


_CROSS = f"""SELECT workflow_id, node_id FROM t WHERE node_flag OR edge_flag"""


@query("cross_cycle", f"{_TURNS} {_CROSS}")
def cross_cycle(spark, sf):
    return catalogue.cross_cycle_nodes(_catalogue(spark, sf))


@query(
    "depends_on_past",
    f"{_TURNS} SELECT workflow_id, bool_or(node_flag OR edge_flag) AS depends_on_past FROM t GROUP BY workflow_id",
)
def depends_on_past(spark, sf):
    return catalogue.depends_on_past(_catalogue(spark, sf))


@query(
    "cross_workflow",
    f"""{_TURNS} SELECT workflow_id, node_id, outside AS external_workflow_id, 'ext_' || outside AS external_node_id
        FROM t WHERE outside IS NOT NULL""",
)
def cross_workflow(spark, sf):
    return catalogue.cross_workflow_deps(_catalogue(spark, sf).nodes)


_REVIEW = f"""{_ROUTED},
    made AS (SELECT DISTINCT workflow_id, out_table FROM n WHERE body <> '' AND output_guid IS NOT NULL),
    m AS (SELECT * FROM n WHERE NOT skipped AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NOT NULL),
    declared AS (SELECT DISTINCT workflow_id, 'bizdate' AS name FROM t UNION SELECT workflow_id, 'region' FROM t
                 UNION SELECT workflow_id, custom FROM t),
    uses AS (SELECT DISTINCT workflow_id, node_id, u,
                    regexp_extract(u, '^(\\w+)', 1) AS name FROM (
               SELECT workflow_id, node_id, unnest(regexp_extract_all(body, '\\$\\{{(\\w+)\\}}', 1)) AS u FROM m
               UNION ALL SELECT workflow_id, node_id, unnest(regexp_extract_all(body, '\\$\\[([A-Za-z_]\\w*(?:\\s*[+-]\\d+)?)\\]', 1)) FROM m)),
    created AS (SELECT *, nullif(regexp_extract(content, '{corpus.NEW_TABLE}', 1), '') AS c
                FROM n WHERE NOT skipped AND command <> 'VIRTUAL' AND target = 'Dataform .sqlx' AND body = ''),
    items AS (
      SELECT workflow_id, node_id, 'skipped' AS kind, command AS detail FROM n WHERE skipped
      UNION ALL SELECT workflow_id, node_id, 'cross_cycle', command FROM n WHERE NOT skipped AND (node_flag OR edge_flag)
      UNION ALL SELECT workflow_id, node_id, 'triage',
                CASE WHEN changed THEN 'set by hand to TRIAGE' ELSE 'Shell script -> BashOperator or PythonOperator; audit each' END
                FROM n WHERE NOT skipped AND command <> 'VIRTUAL' AND target = 'TRIAGE'
      UNION ALL SELECT workflow_id, node_id, 'not_auto', target FROM n
                WHERE NOT skipped AND command <> 'VIRTUAL' AND target NOT IN ('TRIAGE', 'Dataform .sqlx')
      UNION ALL SELECT workflow_id, node_id, 'ddl_only', COALESCE(split_part(c, '.', -1), '?') FROM created
                WHERE NOT EXISTS (SELECT 1 FROM made WHERE made.workflow_id = created.workflow_id AND made.out_table = split_part(created.c, '.', -1))
      UNION ALL SELECT workflow_id, node_id, 'no_output', '' FROM n
                WHERE NOT skipped AND command <> 'VIRTUAL' AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NULL
      UNION ALL SELECT workflow_id, node_id, 'partition', 'pt' FROM m WHERE regexp_matches(content, '(?i)PARTITION\\s*\\(\\s*pt\\s*=')
      UNION ALL SELECT workflow_id, node_id, 'function', 'DATEADD' FROM m WHERE contains(body, 'DATEADD(')
      UNION ALL SELECT workflow_id, node_id, 'reserved', 'source' FROM m WHERE contains(body, ', source')
      UNION ALL SELECT workflow_id, node_id, 'note', note FROM n WHERE NOT skipped AND note IS NOT NULL
      UNION ALL SELECT u.workflow_id, node_id, CASE WHEN d.name IS NULL THEN 'unresolved' ELSE 'offset_not_allowed' END, u.name
                FROM uses u LEFT JOIN declared d ON u.workflow_id = d.workflow_id AND u.name = d.name
                WHERE d.name IS NULL OR (u.u <> u.name AND u.name <> 'bizdate')
      UNION ALL SELECT workflow_id, node_id, 'duplicate', out_table || ' has ' || winner FROM (
                  SELECT *, first_value(node_id) OVER (PARTITION BY workflow_id, out_table ORDER BY turn, source_file) AS winner FROM m)
                WHERE node_id <> winner
      UNION ALL SELECT DISTINCT workflow_id, '', 'cross_workflow', outside FROM t WHERE outside IS NOT NULL)"""

REVIEW_KINDS = (
    "skipped", "cross_cycle", "triage", "not_auto", "ddl_only", "no_output", "partition", "function", "reserved",
    "note", "unresolved", "offset_not_allowed", "duplicate", "cross_workflow", "directive",
)


@query("review_items", f"{_REVIEW} SELECT * FROM items")
def review_items(spark, sf):
    return catalogue.review_items(_catalogue(spark, sf), _overrides(spark, sf), ["workflow_id"], ["line"])


@query(
    "review_counts",
    f"{_REVIEW} SELECT workflow_id, "
    + ", ".join(f"CAST(COUNT(*) FILTER (WHERE kind = '{k}') AS BIGINT) AS n_{k}" for k in REVIEW_KINDS)
    + " FROM items GROUP BY workflow_id",
)
def review_counts(spark, sf):
    items = catalogue.review_items(_catalogue(spark, sf), _overrides(spark, sf), ["workflow_id"], ["line"])
    return catalogue.review_counts(items, REVIEW_KINDS)


@query("renest_documents", f"{_TURNS} SELECT workflow_id, node_id, command, content, before AS upstream_id FROM t")
def renest_documents(spark, sf):
    # Nest nodes to documents, turn these to JSON text, and flatten the text again.
    nested = catalogue.renest(_catalogue(spark, sf).nodes, 500)
    texts = nested.select(
        F.concat_ws("_", "workflow_id", "part").alias("source_file"),
        F.to_json(F.struct("metadata", "kind", "version", "spec")).alias("value"),
    )
    again = catalogue.build_catalogue(parse_documents(texts, "value", "source_file"))
    edges = again.edges.where(~F.startswith("upstream_id", F.lit("ext_"))).select("workflow_id", "node_id", "upstream_id")
    return again.nodes.select("workflow_id", "node_id", "command", "content").join(edges, ["workflow_id", "node_id"], "left")


@query(
    "collect_children",
    """SELECT conv_id, part, COUNT(*) AS n_children, string_agg(text, ' | ' ORDER BY turn) AS children
       FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 4 AS part FROM conversations)
       GROUP BY conv_id, part""",
)
def collect_children(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    nested = ordering.collect_children(rows, "conv_id", ["turn"], F.col("text"), 4)
    return nested.withColumn("children", F.array_join("children", " | "))


@query(
    "renest_headers",
    f"""{_TURNS}, v AS (SELECT workflow_id, custom, arg_min(node_id, source_file) AS first_use FROM t GROUP BY ALL)
        SELECT t.workflow_id, 'conv_' || t.workflow_id AS workflow_name, MIN({_FIVE}) AS schedule, 'UTC' AS timezone,
               COUNT(DISTINCT node_id) AS n_nodes, MIN(region) AS region,
               (SELECT string_agg(custom || '=' || first_use, ',' ORDER BY custom) FROM v WHERE v.workflow_id = t.workflow_id) AS custom
        FROM t GROUP BY t.workflow_id""",
)
def renest_headers(spark, sf):
    # Documents rebuilt with name, trigger and variables from nodes that are all there twice.
    cat = _catalogue(spark, sf)
    nested = catalogue.renest(cat.nodes.unionByName(cat.nodes), 500, catalogue.document_headers(cat))
    texts = nested.select(
        F.concat_ws("_", "workflow_id", "part").alias("source_file"),
        F.to_json(F.struct("metadata", "kind", "version", "spec")).alias("value"),
    )
    again = catalogue.build_catalogue(parse_documents(texts, "value", "source_file"))
    sizes = again.nodes.groupBy("workflow_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    own = again.variables.select("workflow_id", "name", "value").distinct()
    region = own.where("name = 'region'").select("workflow_id", F.col("value").alias("region"))
    pairs = own.where("name LIKE 'k%'").groupBy("workflow_id").agg(
        F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "name", "value"))), ",").alias("custom")
    )
    heads = again.workflows.select("workflow_id", "workflow_name", five_field_schedule(F.col("cron")).alias("schedule"), "timezone")
    return heads.join(sizes, "workflow_id").join(region, "workflow_id").join(pairs, "workflow_id")


_BUILT = f"""{_ROUTED.replace("WITH", "WITH RECURSIVE", 1)},
    m AS (SELECT workflow_id, out_table, turn FROM (
            SELECT *, row_number() OVER (PARTITION BY workflow_id, out_table ORDER BY turn, source_file) AS k FROM n
            WHERE NOT skipped AND target = 'Dataform .sqlx' AND body <> '' AND output_guid IS NOT NULL) WHERE k = 1),
    s AS (SELECT DISTINCT workflow_id, out_table AS x FROM n WHERE output_guid IS NOT NULL),
    e AS (SELECT a.workflow_id, a.out_table AS node, b.out_table AS upstream FROM m a JOIN m b
          ON a.workflow_id = b.workflow_id AND b.out_table = 't_' || ((a.turn + 4) % 5)),
    p AS (SELECT workflow_id, node, upstream FROM e
          UNION SELECT p.workflow_id, p.node, e.upstream FROM p JOIN e ON p.workflow_id = e.workflow_id AND p.upstream = e.node)"""


@query(
    "workflow_parity",
    f"""{_BUILT}, c AS (SELECT s.workflow_id, COUNT(*) AS n_missing FROM s LEFT JOIN m ON s.workflow_id = m.workflow_id AND s.x = m.out_table
                        WHERE m.out_table IS NULL GROUP BY 1),
        z AS (SELECT DISTINCT workflow_id FROM p WHERE node = upstream),
        h AS (SELECT CAST(conv_id AS STRING) || '_' || turn AS node_id, turn, schedule FROM ({_SCHEDULES.replace('{conversations}', 'conversations')})),
        g AS (SELECT t.workflow_id, arg_min(trim(h.schedule), h.turn) AS given FROM t JOIN h ON t.node_id = h.node_id
              WHERE trim(h.schedule) <> '' GROUP BY t.workflow_id),
        w AS (SELECT workflow_id, MIN({_FIVE}) AS f, CAST(COUNT(*) FILTER (WHERE command <> 'VIRTUAL') AS BIGINT) AS n_nodes FROM t GROUP BY workflow_id),
        j AS (SELECT w.*, COALESCE(given, f) AS b, COALESCE(n_missing, 0) AS n_missing, z.workflow_id IS NOT NULL AS cyclic,
                     (SELECT COUNT(*) FROM m WHERE m.workflow_id = w.workflow_id) AS n_models
              FROM w LEFT JOIN c ON w.workflow_id = c.workflow_id LEFT JOIN z ON w.workflow_id = z.workflow_id
              LEFT JOIN g ON w.workflow_id = g.workflow_id),
        d AS (SELECT *, concat_ws(', ', CASE WHEN f <> b THEN 'schedule differs' END,
                     CASE WHEN n_missing > 0 THEN n_missing || ' outputs not built' END,
                     CASE WHEN cyclic THEN 'models depend on each other in a circle' END) AS issues FROM j)
        SELECT workflow_id, n_nodes, n_models, n_missing, 0::BIGINT AS n_extra, cyclic, issues = '' AS ok,
               CASE WHEN issues = '' THEN 'no difference' ELSE issues END AS detail FROM d""",
)
def workflow_parity(spark, sf):
    cat, models = _built(spark, sf)
    overrides = spark.sql(_SCHEDULES, conversations=table(spark, sf, "conversations"))
    schedules = catalogue.workflow_schedules(cat, overrides, ["conv_id", "turn"])
    result = catalogue.built_parity(cat, models, schedules)
    return result.select("workflow_id", "n_nodes", "n_models", "n_missing", "n_extra", "cyclic", "ok", "detail")


def _built(spark, sf):
    cat = _catalogue(spark, sf).stored()
    routed = catalogue.routed_nodes(catalogue.in_run_order(cat), _overrides(spark, sf), ["line"])
    return cat, catalogue.deployable_models(routed)


@query("model_links", f"{_BUILT} SELECT workflow_id, node, upstream FROM e")
def model_links(spark, sf):
    return catalogue.model_links(_built(spark, sf)[1]).select("workflow_id", "node", "upstream")


@query(
    "output_issues",
    f"""{_BUILT} SELECT s.workflow_id, x AS table_name, 'missing' AS kind FROM s LEFT JOIN m ON s.workflow_id = m.workflow_id AND s.x = m.out_table
        WHERE m.out_table IS NULL""",
)
def output_issues(spark, sf):
    cat, models = _built(spark, sf)
    outputs = cat.table_io.where("direction = 'write'").select("workflow_id", "table_name")
    return catalogue.output_issues(outputs, models.select("workflow_id", "table_name"))


# Nodes without an id, and documents that hold a node list beside their workflows.
@query(
    "normalise_union",
    f"""{_TURNS}, k AS (SELECT workflow_id, node_id, 'flow' AS part FROM t WHERE turn % 4 <> 1
          UNION ALL SELECT workflow_id, 'own_' || node_id, 'list' FROM t WHERE turn % 4 <> 2)
        SELECT * FROM k""",
)
def normalise_union(spark, sf):
    docs = documents(spark, sf)
    turn = F.regexp_extract("source_file", r"_(\d+)\.json$", 1).cast("bigint")

    def renamed(node, ident):
        return node.withField("id", ident)

    flows = F.transform(
        "spec.workflows",
        lambda wf: wf.withField(
            "nodes", F.transform(wf["nodes"], lambda n: renamed(n, F.when(turn % 4 == 1, F.lit("")).otherwise(n["id"])))
        ),
    )
    own = F.transform(
        F.col("spec.workflows")[0]["nodes"],
        lambda n: renamed(n, F.when(turn % 4 != 2, F.concat(F.lit("own_"), n["id"]))),
    )
    both = docs.withColumn("spec", F.col("spec").withField("workflows", flows).withField("nodes", own))
    part = F.when(F.startswith("node.id", F.lit("own_")), "list").otherwise("flow")
    return normalise(both, "union").select("workflow_id", F.col("node.id").alias("node_id"), part.alias("part"))


# Test column types, spread over the documents by key: text, collapsed type, Spark type, flagged.
COLUMN_TYPES = (
    ("bigint", "INT64", "bigint", False),
    ("VARCHAR(20)", "STRING", "string", False),
    ("DECIMAL(10,2)", "NUMERIC", "decimal(10,2)", False),
    ("DECIMAL(50,10)", "BIGNUMERIC", "DECIMAL(50,10)", True),
    ("MAP<STRING, BIGINT>", "ARRAY<STRUCT<key STRING, value INT64>>", "map<string, bigint>", False),
    ("ARRAY<DOUBLE>", "ARRAY<FLOAT64>", "array<double>", False),
    ("datetime", "DATETIME", "timestamp_ntz", False),
    ("interval", "INTERVAL", "INTERVAL", True),
    ("boolean", "BOOL", "boolean", False),
    ("ARRAY<DATETIME>", "ARRAY<DATETIME>", "array<timestamp_ntz>", False),
    ("MAP<STRING,ARRAY<INT>>", "ARRAY<STRUCT<key STRING, value ARRAY<INT64>>>", "map<string, array<int>>", False),
    ("STRUCT<a:FOO>", "STRUCT<A:FOO>", "struct<a:FOO>", True),
    ("ARRAY<MAP<STRING, DECIMAL(10, 2)>>", "ARRAY<ARRAY<STRUCT<key STRING, value NUMERIC>>>", "array<map<string, decimal(10,2)>>", False),
    ("array<geo>", "ARRAY<GEO>", "array<GEO>", True),
    ("STRUCT<a:INT, b : ARRAY<VARCHAR(9)>>", "STRUCT<A:INT, B : ARRAY<VARCHAR(9)>>", "struct<a:int, b:array<string>>", False),
    ("MAP<STRING>", "MAP<STRING>", "MAP<STRING>", True),
)


@query(
    "type_map_audit",
    "WITH k AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{a}', '{b}', '{c}', {d})" for i, (a, b, c, d) in enumerate(COLUMN_TYPES))
    + """) v(i, source_type, warehouse_type, spark_type, flagged))
       SELECT 'docs.' || source || '.d' || doc_id AS guid, CAST(p AS INTEGER) AS column_pos, 'c' || p AS column_name,
              source_type, warehouse_type, spark_type, flagged, CASE WHEN p = 0 THEN lang ELSE '' END AS comment
       FROM documents, range(0, 2) r(p), k WHERE k.i = (doc_id + 4 * p) % 16""",
)
def type_map_audit(spark, sf):
    types = F.array(*[F.lit(t[0]) for t in COLUMN_TYPES])

    def column(p):
        kind = F.element_at(types, ((F.col("doc_id") + 4 * p) % len(COLUMN_TYPES) + 1).cast("int"))
        comment = F.col("lang") if p == 0 else F.lit(None).cast("string")
        return F.struct(F.lit(f"c{p}").alias("name"), kind.alias("type"), comment.alias("comment"))

    guid = F.concat(F.lit("docs."), "source", F.lit(".d"), "doc_id")
    metadata = table(spark, sf, "documents").select(guid.alias("guid"), F.array(column(0), column(1)).alias("columns"))
    return catalogue.column_catalogue(metadata)
