"""Write, audit, publish: readers see a load only after it passed its checks.

A table is a folder of versions and a log.  A load writes a version of its own,
which nothing points to; checks read that version; if all pass, one row of
the log names it.  A log row is one file that a committed write puts in place
as a whole, so readers have the old version or the new one, never a part.  A
load that fails or breaks off leaves an unnamed version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirstone.sources.tables import append_table

LOG = "number bigint, version string, schema string, n_checks bigint"


def write_version(df: DataFrame, root: str) -> str:
    """Write a version that no reader sees yet; its name."""
    version = uuid.uuid4().hex
    df.write.parquet(f"{root}/versions/{version}")
    return version


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        log = spark.read.schema(LOG).parquet(f"{root}/log")
        log.isEmpty()
    except Exception as error:  # nothing has been published
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return log


def _last(spark: SparkSession, root: str):
    log = _log(spark, root)
    # of two loads with one number the name decides, the same for every reader
    return None if log is None else log.orderBy(F.desc("number"), F.desc("version")).first()


def write_audit_publish(df: DataFrame, root: str, check: Callable[[DataFrame], DataFrame]) -> bool:
    """Write a version, check it as written, and publish it if no verdict is ``FAIL``.

    ``check`` gives rows with a ``verdict``; a load for which it gives none fails.
    """
    spark = df.sparkSession
    version = write_version(df, root)
    written = spark.read.schema(df.schema).parquet(f"{root}/versions/{version}")
    found = check(written).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.coalesce("verdict", F.lit("FAIL")) == "FAIL").alias("failed")
    ).first()
    if found["failed"] or not found["checks"]:
        return False
    last = _last(spark, root)
    row = (1 + (last["number"] if last else 0), version, df.schema.json(), found["checks"])
    append_table(spark.createDataFrame([row], LOG).coalesce(1), f"{root}/log")
    return True


def read_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The last published version, or an earlier one by its number."""
    log = _log(spark, root)
    if log is None:
        raise ValueError(f"nothing has been published at {root}")
    chosen = log if number is None else log.where(F.col("number") == number)
    last = chosen.orderBy(F.desc("number"), F.desc("version")).first()
    if last is None:
        raise ValueError(f"no version {number} at {root}")
    schema = StructType.fromJson(json.loads(last["schema"]))
    return spark.read.schema(schema).parquet(f"{root}/versions/{last['version']}")
