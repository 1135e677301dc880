"""Assertions and gates on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _long(one_row: DataFrame, table: str, entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    items = [
        F.struct(F.lit(kind).alias("assertion"), F.lit(what).alias("subject"), F.col(col).alias("violations"))
        for kind, what, col in entries
    ]
    return (
        one_row.select(F.explode(F.array(*items)).alias("r"))
        .select(F.lit(table).alias("table_name"), "r.*")
        .withColumn("ok", F.col("violations") == 0)
    )


def assert_table(
    df: DataFrame, table: str, non_null: Sequence[str] = (), conditions: Mapping[str, Column] | None = None
) -> DataFrame:
    """All non-null and row-condition assertions of a table in one pass.

    A row violates a condition if the condition is false or null.  One result
    row per assertion.
    """
    conditions = dict(conditions or {})
    entries, aggs = [], []
    for i, column in enumerate(non_null):
        entries.append(("non_null", column, f"n{i}"))
        aggs.append(F.count_if(F.col(column).isNull()).alias(f"n{i}"))
    for i, (name, condition) in enumerate(conditions.items()):
        entries.append(("row_condition", name, f"c{i}"))
        aggs.append(F.count_if(~F.coalesce(condition, F.lit(False))).alias(f"c{i}"))
    return _long(df.agg(*aggs), table, entries)


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that break a condition."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def min_rows_gate(df: DataFrame, partition: str, minimum: int) -> DataFrame:
    """Row count and PASS or FAIL per partition."""
    n = F.count(F.lit(1))
    return df.groupBy(partition).agg(
        n.alias("n_rows"), F.when(n >= minimum, "PASS").otherwise("FAIL").alias("verdict")
    )


def passing(df: DataFrame, gate: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions that passed their gate."""
    return df.join(gate.where(F.col("verdict") == "PASS").select(partition), partition, "left_semi")


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table, all in one job."""
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in sorted(tables.items())])


def non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and verdict per table."""
    return row_counts(tables).withColumn("ok", F.col("row_count") > 0).withColumn("detail", F.lit(""))


def catalog_tables_non_empty(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """As ``non_empty`` for catalog tables; a missing table is a failed row, not an error."""
    parts = []
    for name in sorted(set(names)):
        if spark.catalog.tableExists(name):
            parts.append(non_empty({name: spark.table(name)}))
        else:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("table_name"),
                    F.lit(None).cast("bigint").alias("row_count"),
                    F.lit(False).alias("ok"),
                    F.lit("table not found").alias("detail"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame, ok: str = "ok") -> DataFrame:
    """One row: passed if there is at least one check and every check holds."""
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.coalesce(F.col(ok), F.lit(False))).alias("n_failed"),
        F.coalesce(F.bool_and(F.coalesce(F.col(ok), F.lit(False))), F.lit(False)).alias("passed"),
    )


def assertion_report(results: Sequence[DataFrame]) -> DataFrame:
    """All assertion results as rows."""
    return reduce(DataFrame.unionByName, results)
