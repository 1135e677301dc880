"""The dated pipeline as one job: landed partitions, facts, gate, aggregate, audit.

Every step reads and writes one run-date partition, so a run costs what its
day holds, and a run that is repeated gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.canonical import checksum, row_hash
from weirstone.operators.keyed import last_per_key
from weirstone.operators.quality import min_rows_gate
from weirstone.session import materialise
from weirstone.sources.tables import append_table, overwrite_partitions, read_partitioned

AUDIT = "run_date string, n_rows bigint, min_rows bigint, verdict string"


@dataclass(frozen=True)
class Landed:
    """A partitioned table: its folder and its columns without the partition column."""

    path: str
    schema: T.StructType

    def day(self, spark: SparkSession, pt: str) -> DataFrame:
        """The rows of one run date; the scan is pruned to their partition."""
        return read_partitioned(spark, self.path, self.schema, "pt", pt)


def land(rows: DataFrame, path: str) -> Landed:
    """Write source rows by their run date ``pt``, replacing only the partitions they hold."""
    overwrite_partitions(rows, path)
    return Landed(path, T.StructType([f for f in rows.schema.fields if f.name != "pt"]))


def day_facts(spark: SparkSession, left: Landed, right: Landed, on: Sequence[str], pt: str) -> DataFrame:
    """Join of one run date of two landed tables; both scans are pruned."""
    return left.day(spark, pt).join(right.day(spark, pt).drop("pt"), list(on))


def run_day(
    spark: SparkSession,
    facts: DataFrame,
    rollup: Callable[[DataFrame], DataFrame],
    facts_path: str,
    mart_path: str,
    audit_path: str,
    pt: str,
    min_rows: int,
) -> str:
    """Store the facts of a run date, and publish their rollup if they pass the gate.

    Either way one audit row tells the count, the threshold and the verdict.  A
    run date without facts fails.
    """
    stored = land(facts.where(F.col("pt") == pt), facts_path)
    day = stored.day(spark, pt)
    gate = min_rows_gate(day, "pt", min_rows)
    found = gate.first()
    n_rows, verdict = (found["n_rows"], found["verdict"]) if found else (0, "FAIL")
    if verdict == "PASS":
        overwrite_partitions(rollup(day), mart_path)
    append_table(spark.createDataFrame([(pt, n_rows, min_rows, verdict)], AUDIT), audit_path)
    return verdict


def run_days(
    facts: DataFrame,
    rollup: Callable[[DataFrame], DataFrame],
    facts_path: str,
    mart_path: str,
    audit_path: str,
    min_rows: int,
) -> None:
    """``run_day`` for every run date of ``facts`` in one pass: the work of a backfill.

    The facts are stored by run date, the gate counts each date, the dates that
    pass are rolled up and published, and each date leaves an audit row.
    ``rollup`` must group by ``pt`` among others.  Dates that are not in
    ``facts`` stay as they are.
    """
    spark = facts.sparkSession
    stored = materialise(facts, "facts")
    overwrite_partitions(stored, facts_path)
    gate = materialise(min_rows_gate(stored, "pt", min_rows), "gate")
    passed = gate.where("verdict = 'PASS'").select("pt")
    overwrite_partitions(rollup(stored.join(passed, "pt", "left_semi")), mart_path)
    audit = gate.select(F.col("pt").alias("run_date"), "n_rows", F.lit(min_rows).cast("bigint").alias("min_rows"), "verdict")
    append_table(spark.createDataFrame([], AUDIT).unionByName(audit), audit_path)


MANIFEST = "pt string, n bigint, checksum string, run bigint"


def source_checks(rows: DataFrame) -> DataFrame:
    """Row count and checksum of each run date of a source."""
    hashed = rows.select("pt", row_hash(rows.schema.fields).alias("h"))
    return hashed.groupBy("pt").agg(F.count(F.lit(1)).alias("n"), checksum(F.col("h")).alias("checksum"))


def changed_days(checks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Run dates whose source is not what the manifest last noted for them, with their checks."""
    last = last_per_key(manifest, ["pt"], ["run"], ["pt", "run", "n", "checksum"])
    known = last.select("pt", F.struct("n", "checksum").alias("_known"))
    rows = checks.join(known, "pt", "left")
    return rows.where(~F.struct("n", "checksum").eqNullSafe(F.col("_known"))).drop("_known")


def backfill(source: DataFrame, rollup: Callable[[DataFrame], DataFrame], mart_path: str, manifest_path: str, run: int) -> int:
    """Compute the run dates whose source changed since they were last computed; how many these are.

    The manifest keeps count and checksum of each date's source, one row per date
    and run.  All changed dates are rolled up in one job that reads their
    partitions only, and without a change nothing is written.  The manifest
    comes last: a run that is lost before it computes the same dates again.
    A date that has left the source keeps what was computed for it.
    """
    spark = source.sparkSession
    try:
        manifest = spark.read.schema(MANIFEST).parquet(manifest_path)
        manifest.isEmpty()
    except Exception as error:  # the first run
        if "PATH_NOT_FOUND" not in str(error):
            raise
        manifest = spark.createDataFrame([], MANIFEST)
    changed = materialise(changed_days(source_checks(source), manifest), "changed")
    days = [r[0] for r in changed.select("pt").collect()]  # one short text per run date
    if not days:
        return 0
    overwrite_partitions(rollup(source.where(F.col("pt").isin(days))), mart_path)
    append_table(changed.select("pt", "n", "checksum", F.lit(run).cast("bigint").alias("run")), manifest_path)
    return len(days)


def gate_failures(gate: DataFrame, min_rows: int) -> DataFrame:
    """The partitions that did not pass, with what they hold and what was asked for."""
    return gate.where(F.col("verdict") == "FAIL").select("pt", "n_rows", F.lit(min_rows).cast("bigint").alias("min_rows"))
