"""Global ranks and ordered parts without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.session import materialise

_INDEX_BITS = 33


def _sorted_ranges(df: DataFrame, order: Sequence[Column], unique: bool) -> DataFrame:
    """``df`` written in sorted ranges, with the range and the place of each row in ``_mid``.

    Rows that tie in ``order`` cannot be put into different ranges, so unless the
    order is unique every row first gets a stored number that breaks ties: a
    group of copies of any size is then cut into as many ranges as it fills.
    """
    if not unique:
        df = materialise(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
        order = [*order, F.col("_tie")]
    sorted_rows = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    return materialise(sorted_rows.drop("_tie"), "rank")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "pos", unique: bool = False) -> DataFrame:
    """Number all rows 1, 2, ... in ``order``; ``unique`` says that no two rows tie.

    A range sort spreads the rows over all tasks and is written once; the row
    count of each sorted range gives the offset of the next.  Only those
    counts, one per shuffle partition, meet in one task.
    """
    stored = _sorted_ranges(df, list(order), unique)
    part = F.shiftright("_mid", _INDEX_BITS)
    index = F.col("_mid").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + index + 1).cast("bigint"))
        .drop("_part", "_mid", "_offset")
    )


def ordered_parts(
    df: DataFrame, parent: str, order: Sequence[str], size: int, name: str = "part", unique: bool = False
) -> DataFrame:
    """Give each row a part number so that no (parent, part) has more than ``size`` rows.

    Parts are numbered from 0 within each parent, follow its order and are
    contiguous; only a parent of more than ``size`` rows has several.  The first
    rank of each parent, one row per parent, is joined back.
    """
    ranked = global_rank(df, [F.col(parent), *[F.col(c) for c in order]], "_rank", unique)
    first = ranked.groupBy(F.col(parent).alias("_parent")).agg(F.min("_rank").alias("_first"))
    placed = ranked.join(first, F.col(parent).eqNullSafe(F.col("_parent")))
    part = F.floor((F.col("_rank") - F.col("_first")) / size).cast("bigint")
    return placed.withColumn(name, part).drop("_parent", "_first")


def collect_children(
    df: DataFrame, parent: str, order: Sequence[str], child: Column, size: int, name: str = "children", unique: bool = False
) -> DataFrame:
    """Ordered child lists per parent, in parts of at most ``size`` children."""
    parts = ordered_parts(df, parent, order, size, unique=unique)
    rows = F.sort_array(F.collect_list(F.struct(F.col("_rank"), child.alias("child"))))
    return (
        parts.groupBy(parent, "part")
        .agg(F.count(F.lit(1)).alias("n_children"), F.transform(rows, lambda r: r["child"]).alias(name))
    )


def ordered_concat(df: DataFrame, key: str, value: str, size: int, separator: str = ",") -> DataFrame:
    """Distinct values per key as ordered text, in parts of at most ``size`` values."""
    pairs = df.select(key, value).distinct()
    parts = collect_children(pairs, key, [value], F.col(value), size, "names", unique=True)
    return parts.select(key, "part", F.array_join("names", separator).alias("joined"))
