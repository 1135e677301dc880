"""Delimited text: fixed-schema scans, malformed rows, standardisation, override files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.names import blank_to_null

CORRUPT = "_corrupt_line"
# How both scans of delimited text read times.
TIMES = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}

# The columns of the override file, in file order.
MATRIX_FIELDS = (
    "workflow", "node_id", "node_name", "command", "input_tables",
    "output_tables", "schedule", "gcp_target", "review_notes", "skip",
)
MATRIX_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in MATRIX_FIELDS])


def scan_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", header: bool = False
) -> DataFrame:
    """Scan delimited text with a fixed schema; a malformed row fails the scan.

    All fields are parsed even if few are read, so that no malformed field is overlooked.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .options(**TIMES)
        .csv(path)
    )


def scan_with_quarantine(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """Scan delimited text and separate well-formed rows from malformed lines.

    A line with too few or too many fields, or with a value that does not fit
    its column type, is malformed.  Blank lines are no rows, as in ``scan_delimited``.
    """
    # Lines are parsed one by one as an expression: a scan would prune columns
    # and then not see that a pruned field is malformed.
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **TIMES}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.fields)
    lines = spark.read.text(path).where(F.trim("value", F.lit(" \t\r")) != "")
    parsed = lines.select("value", F.from_csv("value", ddl, options).alias("r"))
    good = parsed.where(F.col(f"r.{CORRUPT}").isNull()).select(*[f"r.`{f.name}`" for f in schema.fields])
    bad = parsed.where(F.col(f"r.{CORRUPT}").isNotNull()).select(F.col("value").alias("line"))
    return good, bad


def standardise(
    df: DataFrame,
    renames: Mapping[str, str] | None = None,
    unquote: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rename columns, strip double quotes, and encode flag columns as 1/0.

    ``flags`` maps a column to the text that means yes.
    """
    df = df.withColumnsRenamed(dict(renames or {}))
    changes: dict[str, Column] = {c: F.regexp_replace(F.col(c), '"', "") for c in unquote}
    for column, yes in (flags or {}).items():
        source = changes.get(column, F.col(column))
        changes[column] = F.when(source == yes, 1).otherwise(0).cast("bigint")
    return df.withColumns(changes) if changes else df


def scan_overrides(spark: SparkSession, path: str, schema: T.StructType = MATRIX_SCHEMA, key: str = "node_id") -> DataFrame:
    """Scan a hand-edited override file; a blank cell means no override.

    Columns go by the names in the header, in any order; all files of a path
    must have the same header.  Quoted cells may hold line feeds, a row with a
    wrong number of cells fails the scan, and rows without a key are left out.
    """
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"the override file has no column {missing}")
    cells = raw.select(*[blank_to_null(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema.fields])
    return cells.where(F.col(key).isNotNull())
