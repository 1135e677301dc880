"""Set comparison, as one aggregation each instead of several joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both sides with ``in_left`` and ``in_right``."""
    both = left.select(*keys, F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select(*keys, F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    return both.groupBy(*keys).agg(F.max("l").alias("in_left"), F.max("r").alias("in_right"))


def missing_and_extra(source: DataFrame, built: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only: ``missing`` from the built side, or ``extra`` in it."""
    sides = membership(source, built, keys).where(F.col("in_left") != F.col("in_right"))
    kind = F.when(F.col("in_left"), "missing").otherwise("extra")
    return sides.select(*keys, kind.alias("kind"))


def missing_and_extra_counts(source: DataFrame, built: DataFrame, group: str, keys: Sequence[str]) -> DataFrame:
    """Per group: keys in both sides, missing and extra."""
    sides = membership(source, built, [group, *keys])
    return sides.groupBy(group).agg(
        F.count_if(F.col("in_left") & F.col("in_right")).alias("n_common"),
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("n_missing"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("n_extra"),
    )


def common(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that occur on both sides."""
    return membership(left, right, keys).where(F.col("in_left") & F.col("in_right")).select(*keys)


def any_detector(detectors: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct keys that at least one detector found."""
    found = detectors[0].select(key)
    for other in detectors[1:]:
        found = found.unionByName(other.select(key))
    return found.distinct()


def row_difference(source: DataFrame, target: DataFrame) -> DataFrame:
    """Multiset difference of two tables in both directions, in one shuffle.

    Equal rows are counted before they move.  ``copies`` says how often a row
    stands on one side beyond the other.
    """
    columns = source.columns
    signed = source.select(*columns, F.lit(1).alias("_d")).unionByName(
        target.select(*columns, F.lit(-1).alias("_d"))
    )
    net = signed.groupBy(*columns).agg(F.sum("_d").alias("_d")).where(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, "source_only").otherwise("target_only")
    return net.select(*columns, side.alias("side"), F.abs("_d").cast("bigint").alias("copies"))
