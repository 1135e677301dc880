"""Workflow documents: schema, scan, and normalisation to one node list.

A document is one of three shapes: a node on its own, a list of nodes, or a
list of workflows that hold nodes.  A workflow may arrive in several documents
(one per node, or in parts); everything downstream goes by workflow id, so no
job ever needs a whole workflow in one row.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.session import materialise

_REF = (
    "struct<data:string,artifactType:string,externalWorkflowId:string,externalNodeId:string,"
    "crossCycleDependsOnOtherNode:boolean>"
)
_NODE_FIELDS = (
    "id:string,name:string,recurrence:string,crossCycleDependsOnOtherNode:boolean,"
    "script:struct<id:string,path:string,language:string,"
    "runtime:struct<command:string,commandTypeId:int>,content:string>,"
    f"inputs:struct<tables:array<struct<guid:string>>,nodeOutputs:array<{_REF}>>,"
    "outputs:struct<tables:array<struct<guid:string>>,"
    "nodeOutputs:array<struct<data:string,artifactType:string>>>,"
    "branches:array<struct<condition:string,goto:struct<nodeId:string,type:string>>>"
)
NODE = f"struct<{_NODE_FIELDS}>"
FLOW = (
    "struct<nodeId:string,depends:array<struct<nodeId:string,data:string,type:string,"
    "crossCycleDependsOnOtherNode:boolean>>>"
)
TRIGGER = "struct<type:string,cron:string,startTime:string,endTime:string,timezone:string>"
STRATEGY = (
    "struct<timeout:bigint,instanceMode:string,rerunMode:string,rerunTimes:int,rerunInterval:bigint>"
)
VARIABLE = "struct<id:string,name:string,scope:string,type:string,value:string>"
WORKFLOW = (
    "struct<id:string,name:string,script:struct<path:string,runtime:struct<command:string>>,"
    f"trigger:{TRIGGER},strategy:{STRATEGY},variables:array<{VARIABLE}>,"
    f"nodes:array<{NODE}>,flow:array<{FLOW}>>"
)
_SPEC_FIELDS = (
    f"type:string,owner:string,trigger:{TRIGGER},nodes:array<{NODE}>,flow:array<{FLOW}>,"
    f"workflows:array<{WORKFLOW}>"
)
_INNER = f"struct<{_NODE_FIELDS},{_SPEC_FIELDS}>"
_SPEC = f"struct<{_NODE_FIELDS},{_SPEC_FIELDS},spec:{_INNER}>"

def document_schema() -> T.StructType:
    """The explicit schema of every document shape."""
    fields = (
        "metadata:struct<tenantId:string,projectId:string,uuid:string>,kind:string,version:string,"
        f"workflow_id:string,{_NODE_FIELDS},{_SPEC_FIELDS},spec:{_SPEC}"
    )
    return _parse(f"struct<{fields}>")


CORRUPT = "_corrupt_document"


@lru_cache(maxsize=None)
def _parse(ddl: str) -> T.StructType:
    return T.DataType.fromDDL(ddl)


def scan_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scan JSON documents (a folder or glob), keeping the name of each file."""
    return (
        spark.read.schema(document_schema())
        .option("multiLine", multi_line)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def parse_documents(texts: DataFrame, text: str, source_file: str) -> DataFrame:
    """Documents held as JSON text in a table column; ``document_rejects`` has those that do not parse."""
    return parse_with_rejects(texts, text, source_file)[0]


def parse_with_rejects(texts: DataFrame, text: str, source_file: str) -> tuple[DataFrame, DataFrame]:
    """Documents held as JSON text, and the texts that are no such document.

    A text is rejected if it is null or blank, if it is cut off or otherwise no
    JSON, or if a field has a value of another type than documents have.

    The parse is written once, with the text of what failed beside it, and both
    results read what was written: a filter or a field of a later step would
    else carry the parse, with its whole schema, into every expression.
    """
    schema = T.StructType([*document_schema().fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    own = texts.select(F.col(source_file).alias("source_file"), F.col(text).cast("string").alias("value"))
    parsed = own.select("source_file", "value", F.from_json("value", schema, options).alias("d"))
    # a text that is not taken as a document at all has no row of fields to hold it
    rows = materialise(parsed.withColumn("value", F.when(F.col("d").isNull(), F.col("value"))), "documents")
    bad = F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()
    good = rows.where(~bad).select(*[f"d.`{f.name}`" for f in document_schema().fields], "source_file")
    return good, rows.where(bad).select("source_file", F.coalesce("value", f"d.{CORRUPT}").alias("value"))


def scan_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents in files of one document each, and the files that hold none, with their text."""
    files = spark.read.option("wholetext", True).text(path).withColumn("source_file", F.col("_metadata.file_name"))
    return parse_with_rejects(files, "value", "source_file")


def normalise(docs: DataFrame, shapes: str = "first") -> DataFrame:
    """One row per node, whatever the shape of its document.

    ``first`` takes the first shape that fits: a node, a node list, the first
    workflow.  ``workflows`` takes all workflows of a document, or its node or
    node list if it has none.  ``union`` takes node list and workflows.  Nodes
    without an id are dropped.
    """
    # A landed node file wraps its document once more than a workflow file.
    listed = _either("nodes")
    flows = _either("workflows")
    landed = F.col("workflow_id").isNotNull()
    bare = listed.isNull() & flows.isNull()
    single = F.when(bare & F.col("script").isNotNull(), F.array(_node_at(""))).when(
        bare & F.col("spec.script").isNotNull(), F.array(_node_at("spec."))
    )
    own_id = F.coalesce(
        F.col("workflow_id"), F.col("spec.id"), F.col("metadata.uuid"), F.when(listed.isNotNull(), F.col("id"))
    )
    own_name = F.when(landed, F.concat(F.lit("workflow_"), F.col("workflow_id"))).otherwise(
        F.coalesce(F.col("spec.name"), F.when(listed.isNotNull(), F.col("name")))
    )
    source = F.col("source_file") if "source_file" in docs.columns else F.lit(None).cast("string").alias("source_file")
    staged = docs.select(
        source,
        landed.alias("landed"),
        own_id.alias("own_id"),
        own_name.alias("own_name"),
        F.coalesce(single, listed).alias("listed"),
        F.filter(
            F.transform(
                flows,
                lambda wf, i: F.struct(i.cast("int").alias("pos"), wf["id"].alias("id"), wf["name"].alias("name"), wf["nodes"].alias("nodes")),
            ),
            lambda part: part["nodes"].isNotNull(),
        ).alias("flows"),
    )
    part_type = f"array<struct<pos:int,id:string,name:string,nodes:array<{NODE}>>>"
    none = F.lit(None).cast("string")
    as_list = F.array(
        F.struct(F.lit(0).alias("pos"), none.alias("id"), none.alias("name"), F.col("listed").alias("nodes"))
    ).cast(part_type)
    in_flows = F.coalesce(F.col("flows"), F.array().cast(part_type))
    has_list, has_flows = F.col("listed").isNotNull(), F.size(in_flows) > 0
    parts = {
        "first": F.when(has_list, as_list).otherwise(F.slice(in_flows, 1, 1)),
        "workflows": F.when(has_flows | ~has_list, in_flows).otherwise(as_list),
        "union": F.when(has_list, F.concat(as_list, in_flows)).otherwise(in_flows),
    }[shapes]
    by_part = staged.select("source_file", "landed", "own_id", "own_name", F.explode(parts).alias("part"))
    return by_part.select(
        "source_file",
        F.when(F.col("landed"), F.col("own_id")).otherwise(F.coalesce("part.id", "own_id")).alias("workflow_id"),
        F.when(F.col("landed"), F.col("own_name")).otherwise(F.coalesce("part.name", "own_name")).alias("workflow_name"),
        "landed",
        F.col("part.pos").alias("workflow_pos"),
        F.posexplode("part.nodes").alias("node_pos", "node"),
    ).where(F.coalesce(F.col("node.id"), F.lit("")) != "")


def _either(field: str) -> Column:
    return F.coalesce(F.col(f"spec.spec.{field}"), F.col(f"spec.{field}"), F.col(field))


def workflow_headers(docs: DataFrame) -> DataFrame:
    """One row per workflow of a document: header, variables and flow, without nodes.

    A node list counts as one workflow; a landed node file names its workflow only.
    """
    header_type = f"array<struct<id:string,name:string,trigger:{TRIGGER},strategy:{STRATEGY},variables:array<{VARIABLE}>,flow:array<{FLOW}>>>"
    flows = F.transform(
        _either("workflows"),
        lambda wf: F.struct(
            F.coalesce(wf["id"], F.col("spec.id"), F.col("metadata.uuid")).alias("id"),
            F.coalesce(wf["name"], F.col("spec.name")).alias("name"),
            *[wf[f].alias(f) for f in ("trigger", "strategy", "variables", "flow")],
        ),
    ).cast(header_type)
    none = F.lit(None)
    own = F.array(
        F.struct(
            F.coalesce("spec.id", "metadata.uuid", "id").alias("id"),
            F.coalesce("spec.name", "name").alias("name"),
            F.coalesce("spec.trigger", "trigger").alias("trigger"),
            none.alias("strategy"),
            none.alias("variables"),
            F.coalesce("spec.flow", "flow").alias("flow"),
        )
    ).cast(header_type)
    name_only = F.array(
        F.struct(
            F.col("workflow_id").alias("id"),
            F.concat(F.lit("workflow_"), "workflow_id").alias("name"),
            *[none.alias(f) for f in ("trigger", "strategy", "variables", "flow")],
        )
    ).cast(header_type)
    landed = F.col("workflow_id").isNotNull()
    headers = (
        F.when(landed, name_only)
        .when(F.coalesce(F.size(flows), F.lit(0)) > 0, flows)
        .when(_either("nodes").isNotNull(), own)
    )
    source = F.col("source_file") if "source_file" in docs.columns else F.lit(None).cast("string").alias("source_file")
    return docs.select(source, landed.alias("landed"), F.posexplode(headers).alias("workflow_pos", "wf")).where(
        F.col("wf.id").isNotNull()
    )


def _node_at(prefix: str) -> Column:
    return F.struct(*[F.col(prefix + f.name).alias(f.name) for f in _parse(NODE).fields])


def prefer_then_fallback(preferred: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All preferred rows, and fallback rows for keys that have no preferred row."""
    known = preferred.select(key).distinct()
    return preferred.unionByName(fallback.join(known, key, "left_anti"), allowMissingColumns=True)
