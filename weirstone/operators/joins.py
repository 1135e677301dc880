"""Joins that the pipelines and the catalogue need.

Key sets on the filtering side of a semi or anti join are made distinct first
(map-side combine), so only the other side can be skewed, and that side AQE
can split.  Nothing is broadcast by hint unless its size was checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions.names import blank_to_null
from weirstone.operators.keyed import last_per_key

# Bytes that a side sent to every task may have in memory, and how much larger than its files' share
# of the optimizer's estimate it is taken to be there (compressed columns, row overhead).
BROADCAST_BYTES = 64 << 20
EXPANSION = 10


def estimated_bytes(df: DataFrame) -> int:
    """Size of a result as the optimizer sees it; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def map_side_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join with the small side sent to every task if ``EXPANSION`` times its estimate is ``max_bytes`` at most.

    The estimate of a scan is the size of its compressed files, so it is no
    upper bound by itself.  Beyond the bound this is an ordinary join that
    Spark plans by its own threshold and at run time.
    """
    side = F.broadcast(small) if EXPANSION * estimated_bytes(small) <= max_bytes else small
    return big.join(side, list(on), how)


def override_merge(
    auto: DataFrame, overrides: DataFrame, key: str, fields: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Replace automatic values by non-blank override values.

    The last override row of a key counts.  Adds ``<field>_overridden``, which
    is false where the override only repeats the automatic value.
    """
    latest = last_per_key(overrides, [key], order, [key, *order, *fields])
    renamed = latest.select(key, *[blank_to_null(F.col(f)).alias(f"_ov_{f}") for f in fields])
    joined = auto.join(renamed, key, "left")
    out: list[Column] = [F.col(c) for c in auto.columns if c not in fields]
    for f in fields:
        given = F.col(f"_ov_{f}")
        out.append(F.coalesce(given, F.col(f)).alias(f))
        out.append((given.isNotNull() & ~given.eqNullSafe(F.col(f))).alias(f"{f}_overridden"))
    return joined.select(*out)


def split_skipped(df: DataFrame, overrides: DataFrame, key: str, flag: str = "skip") -> DataFrame:
    """All rows with ``skipped``: true where an override says so, in any case or spacing."""
    is_set = F.lower(F.trim(F.col(flag))) == "true"
    skipped = overrides.where(is_set).select(key).distinct().withColumn("skipped", F.lit(True))
    return df.join(skipped, key, "left").withColumn("skipped", F.coalesce(F.col("skipped"), F.lit(False)))


def keep_selected(df: DataFrame, entries: DataFrame, entry: str, name: str, ident: str) -> DataFrame:
    """Rows whose name or id is listed; a row that matches both ways is taken once.

    The listed rows are found by their (name, id) pairs, so the table itself is
    read for the pairs and once more for the rows.
    """
    listed = entries.where(F.coalesce(F.col(entry), F.lit("")) != "").select(F.col(entry).alias("_e")).distinct()
    ends = df.select(F.col(name).alias("_n"), F.col(ident).alias("_i")).distinct()
    either = ends.select("_n", "_i", F.explode(F.array_distinct(F.array("_n", "_i"))).alias("_e"))
    wanted = either.join(listed, "_e", "left_semi").select("_n", "_i").distinct()
    same = F.col(name).eqNullSafe(F.col("_n")) & F.col(ident).eqNullSafe(F.col("_i"))
    return df.join(wanted, same, "left_semi")


def unmatched_entries(df: DataFrame, entries: DataFrame, entry: str, name: str, ident: str) -> DataFrame:
    """Listed entries that match no name and no id."""
    listed = entries.where(F.coalesce(F.col(entry), F.lit("")) != "").select(entry).distinct()
    known = df.select(F.col(name).alias(entry)).unionByName(df.select(F.col(ident).alias(entry))).distinct()
    return listed.join(known, entry, "left_anti")


def read_not_produced(reads: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """Distinct entities that are read but that nothing produces."""
    return reads.select(key).distinct().join(produced.select(key).distinct(), key, "left_anti")


def absorb_or_flag(candidates: DataFrame, produced: DataFrame, key: str) -> DataFrame:
    """Mark candidates as absorbed where something produces the same entity."""
    made = produced.select(key).distinct().withColumn("_made", F.lit(True))
    status = F.when(F.col("_made"), F.lit("absorbed")).otherwise(F.lit("flagged"))
    return candidates.join(made, key, "left").withColumn("status", status).drop("_made")


def known_edges(edges: DataFrame, nodes: DataFrame, source: str, target: str, node: str) -> DataFrame:
    """Edges whose two ends are known nodes."""
    ids = nodes.select(F.col(node).alias("_n")).distinct()
    return edges.join(ids, F.col(source) == F.col("_n"), "left_semi").join(
        ids, F.col(target) == F.col("_n"), "left_semi"
    )
