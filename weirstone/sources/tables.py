"""Table sinks and partitioned reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("workflow", T.StringType()),
        T.StructField("bizdate", T.StringType()),
        T.StructField("completed_at", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_written", T.LongType()),
    ]
)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "pt") -> None:
    """Replace only the partitions that ``df`` holds; a rerun gives the same table.

    The rebalance hint gathers each partition value into few files, and AQE
    splits a value that holds most of the rows over many tasks.
    """
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType, partition: str = "pt", value: str | None = None
) -> DataFrame:
    """Read a partitioned table; the partition column stays text, and a given
    value prunes the scan to its partition."""
    fields = [f for f in schema.fields if f.name != partition]
    full = T.StructType(fields + [T.StructField(partition, T.StringType())])
    df = spark.read.schema(full).parquet(path)
    return df if value is None else df.where(F.col(partition) == value)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write text with a header line and columns in a fixed order."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_with_audit(
    df: DataFrame, path: str, audit_path: str, workflow: str, bizdate: str, partition: str | None = None
) -> None:
    """Write a table and append one audit row; the row count is taken during the write."""
    spark = df.sparkSession
    seen = Observation(f"audit-{workflow}")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows_written"))
    if partition is None:
        overwrite_table(watched, path)
    else:
        overwrite_partitions(watched, path, partition)
    record = spark.range(1).select(
        F.lit(workflow).alias("workflow"),
        F.lit(bizdate).alias("bizdate"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("completed_at"),
        F.lit("SUCCESS").alias("status"),
        F.lit(int(seen.get["rows_written"])).cast("bigint").alias("rows_written"),
    )
    append_table(record, audit_path)
