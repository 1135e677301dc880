"""Workflow documents derived from the conversations table.

A conversation is a workflow and a turn is a node that depends on the turn
before.  Every turn lands as one document, so nothing is grouped to make the
documents and a conversation of any length is as good as many short ones.

The expressions are plain SQL that Spark and the SQL check both read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.plans.registry import table
from weirstone.sources.documents import parse_documents

FIELDS = {
    "workflow_id": "CAST(conv_id AS STRING)",
    "node_id": "CAST(conv_id AS STRING) || '_' || CAST(turn AS STRING)",
    "before": "CASE WHEN turn > 0 THEN CAST(conv_id AS STRING) || '_' || CAST(turn - 1 AS STRING) END",
    "command": """CASE WHEN role = 'user' THEN 'ODPS_SQL' WHEN role = 'assistant' AND turn % 4 = 3 THEN 'DIDE_SHELL'
                  WHEN role = 'assistant' THEN 'PYODPS' ELSE 'VIRTUAL' END""",
    "content": """CASE
        WHEN role = 'user' AND (turn + conv_id) % 5 = 0
        THEN 'CREATE TABLE IF NOT EXISTS t_' || CAST(turn % 5 AS STRING) || ' (id BIGINT);'
        WHEN role = 'user'
        THEN 'INSERT OVERWRITE TABLE t_' || CAST(turn % 5 AS STRING)
             || CASE WHEN conv_id % 2 = 0 THEN ' PARTITION (pt=' || chr(39) || '$' || '{bizdate}' || chr(39) || ')' ELSE '' END
             || chr(10) || 'SELECT NVL(a, ' || CAST(length(text) AS STRING) || ')'
             || CASE WHEN turn % 2 = 0 THEN ', DATEADD(b, 1)' ELSE ', source' END
             || chr(10) || 'FROM p.t_' || CAST((turn + 4) % 5 AS STRING) || ' x JOIN dim_' || CAST(conv_id % 3 AS STRING)
             || chr(10) || 'WHERE c = ' || '$' || '{' || CASE WHEN conv_id % 5 = 0 THEN 'region' ELSE 'k_' || CAST(turn % 4 AS STRING) END
             || '} AND d = $' || '[' || CASE WHEN turn % 3 = 1 THEN 'bizdate-1' WHEN turn % 3 = 2 THEN 'region+2' ELSE 'bizdate' END || '];'
        ELSE text END""",
    "input_guid": "CASE WHEN role = 'user' THEN 'odps.p.t_' || CAST((turn + 4) % 5 AS STRING) END",
    "output_guid": """CASE WHEN role = 'user' AND NOT (conv_id % 13 = 0 AND turn % 3 = 2)
                      THEN 'odps.p.t_' || CAST(turn % 5 AS STRING) END""",
    "cron": "'00 ' || lpad(CAST(conv_id % 60 AS STRING), 2, '0') || ' ' || lpad(CAST(conv_id % 24 AS STRING), 2, '0') || ' * * ?'",
    "node_flag": "conv_id % 10 = 5 AND turn % 2 = 0",
    "edge_flag": "conv_id % 10 = 0 AND turn > 0",
    "outside": "CASE WHEN conv_id % 7 = 0 AND turn % 4 = 0 THEN CAST(conv_id + 1 AS STRING) END",
    "region": "'r' || CAST(conv_id % 5 AS STRING)",
    "custom": "'k_' || CAST(turn % 2 AS STRING)",
    "source_file": "'workflow_' || lpad(CAST(conv_id AS STRING), 12, '0') || '_' || lpad(CAST(turn AS STRING), 12, '0') || '.json'",
}

# The same fields for the SQL check.
TURNS_SQL = "SELECT conv_id, turn, role, text, " + ", ".join(f"{e} AS {n}" for n, e in FIELDS.items()) + " FROM conversations"


def turns(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    return rows.selectExpr("conv_id", "turn", "role", "text", *[f"{e} AS {n}" for n, e in FIELDS.items()])


def _node():
    def one(condition: str, item):
        return F.when(F.expr(condition), F.array(item))

    upstream = F.struct(
        F.col("before").alias("data"),
        F.lit("NodeOutput").alias("artifactType"),
        F.lit(None).cast("string").alias("externalWorkflowId"),
    )
    outside = F.struct(
        F.concat(F.lit("ext_"), "outside").alias("data"),
        F.lit("NodeOutput").alias("artifactType"),
        F.col("outside").alias("externalWorkflowId"),
    )
    refs = F.filter(F.array(upstream, outside), lambda r: r["data"].isNotNull())
    return F.struct(
        F.col("node_id").alias("id"),
        F.concat(F.lit("turn_"), "turn").alias("name"),
        F.when(F.expr("node_flag"), F.lit(True)).alias("crossCycleDependsOnOtherNode"),
        F.struct(F.struct(F.col("command").alias("command")).alias("runtime"), F.col("content").alias("content")).alias("script"),
        F.struct(
            one("input_guid IS NOT NULL", F.struct(F.col("input_guid").alias("guid"))).alias("tables"),
            refs.alias("nodeOutputs"),
        ).alias("inputs"),
        F.struct(one("output_guid IS NOT NULL", F.struct(F.col("output_guid").alias("guid"))).alias("tables")).alias("outputs"),
    )


def _workflow():
    depends = F.struct(F.col("before").alias("nodeId"), F.when(F.expr("edge_flag"), "CrossCycle").otherwise("Normal").alias("type"))
    flow = F.struct(
        F.col("node_id").alias("nodeId"),
        F.filter(F.array(depends), lambda d: d["nodeId"].isNotNull()).alias("depends"),
    )

    def variable(name, kind, value):
        return F.struct(name.alias("name"), F.lit(kind).alias("type"), value.alias("value"))

    return F.struct(
        F.col("workflow_id").alias("id"),
        F.concat(F.lit("conv_"), "workflow_id").alias("name"),
        F.struct(F.col("cron").alias("cron"), F.lit("UTC").alias("timezone")).alias("trigger"),
        F.array(
            variable(F.lit("bizdate"), "System", F.lit("${bizdate}")),
            variable(F.lit("region"), "Custom", F.col("region")),
            variable(F.col("custom"), "Custom", F.col("node_id")),
        ).alias("variables"),
        F.array(_node()).alias("nodes"),
        F.array(flow).alias("flow"),
    )


def document_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One workflow document per turn, as JSON text."""
    body = F.struct(
        F.lit("CycleWorkflow").alias("kind"),
        F.struct(
            F.concat(F.lit("conv_"), "workflow_id").alias("name"),
            F.col("workflow_id").alias("id"),
            F.array(_workflow()).alias("workflows"),
        ).alias("spec"),
    )
    return turns(spark, sf).select("source_file", F.to_json(body).alias("value"))


def mixed_shape_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The same nodes in three shapes by turn: in a workflow, in a node list, and as a landed node file."""
    name = F.concat(F.lit("conv_"), "workflow_id").alias("name")
    ident = F.col("workflow_id").alias("id")
    flow_shape = F.to_json(F.struct(F.struct(name, ident, F.array(_workflow()).alias("workflows")).alias("spec")))
    list_shape = F.to_json(F.struct(F.struct(name, ident, F.array(_node()).alias("nodes")).alias("spec")))
    node_shape = F.to_json(
        F.struct(F.col("node_id").alias("id"), F.col("workflow_id"), _node().alias("spec"))
    )
    text = F.when(F.expr("turn % 3 = 0"), flow_shape).when(F.expr("turn % 3 = 1"), list_shape).otherwise(node_shape)
    return turns(spark, sf).select("source_file", text.alias("value"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return parse_documents(document_texts(spark, sf), "value", "source_file")
