"""Keyed de-duplication and merging.

All "one row per key" operators are min/max aggregates over an ordered struct,
so every map task sends at most one row per key to the shuffle and a key that
holds a third of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None, last: bool) -> DataFrame:
    rest = [c for c in (columns or df.columns) if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in (*order, *rest)])
    chosen = (F.max if last else F.min)(row).alias("row")
    out = [*keys, *[F.col(f"row.`{c}`").alias(c) for c in (*order, *rest)]]
    picked = df.groupBy(*keys).agg(chosen).select(*out)
    wanted = columns or df.columns
    return picked.select(*[c for c in wanted])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key in ``order``; further columns break ties."""
    return _pick(df, keys, order, columns, last=False)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The last row of each key in ``order``: later rows replace earlier ones."""
    return _pick(df, keys, order, columns, last=True)


def repeated_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys with more than one row: the winner's order columns, rows and losers."""
    first = F.min(F.struct(*order)).alias("winner")
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), first)
        .where(F.col("n_rows") > 1)
        .select(
            *keys,
            *[F.col(f"winner.`{c}`").alias(f"winner_{c}") for c in order],
            "n_rows",
            (F.col("n_rows") - 1).alias("n_losers"),
        )
    )


def later_writers(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row that is not the first of its key, with the winner's order columns.

    ``order`` must identify a row within its key.
    """
    winners = repeated_keys(df, keys, order)
    marks = [F.col(f"winner_{c}") for c in order]
    same = None
    for c in order:
        term = F.col(c).eqNullSafe(F.col(f"winner_{c}"))
        same = term if same is None else same & term
    return df.join(winners.select(*keys, *marks), list(keys), "inner").where(~same)


def dedupe_keep_null(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """First row per key; rows without a key are all kept."""
    wanted = list(columns or df.columns)
    keyed = first_per_key(df.where(F.col(key).isNotNull()), [key], order, [*wanted, *([] if key in wanted else [key])])
    return keyed.select(*wanted).unionByName(df.where(F.col(key).isNull()).select(*wanted))


def merge_priority(stores: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of stores with one row per key; a later store wins over an earlier one."""
    columns = stores[0].columns
    tagged = None
    for rank, store in enumerate(stores):
        part = store.select(*columns, F.lit(rank).alias("store_rank"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return last_per_key(tagged, [key], ["store_rank"]).select(*columns)


def first_non_blank(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """First non-blank value per group in ``order``; null if a group has none."""
    filled = F.trim(F.col(value)) != ""
    row = F.struct(*order, F.col(value).alias("value"))
    return df.groupBy(*keys).agg(F.min(F.when(filled, row)).getField("value").alias(name))


def first_of_class(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], in_class: Column, value: str, name: str, default: str
) -> DataFrame:
    """``value`` of the first row per group that is in a class, else a default."""
    row = F.struct(*order, F.col(value).alias("value"))
    found = F.min(F.when(in_class, row)).getField("value")
    return df.groupBy(*keys).agg(F.coalesce(found, F.lit(default)).alias(name))


def pending(listed: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Listed items that are not stored yet."""
    return listed.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def insert_ignore(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` that an append must write: new keys only, first row each."""
    fresh = pending(batch, stored, keys)
    return first_per_key(fresh, keys, order)


def complete_groups(expected: DataFrame, stored: DataFrame, parent: str, child: Sequence[str]) -> DataFrame:
    """Parents with all children stored: expected and stored counts per parent.

    ``child`` identifies a child within its parent; both sides count distinct children.
    """
    sides = expected.select(parent, *child, F.lit(1).alias("e"), F.lit(0).alias("s")).unionByName(
        stored.select(parent, *child, F.lit(0).alias("e"), F.lit(1).alias("s"))
    )
    per_child = sides.groupBy(parent, *child).agg(F.max("e").alias("e"), F.max("s").alias("s"))
    return (
        per_child.where(F.col("e") == 1)
        .groupBy(parent)
        .agg(F.sum("e").cast("bigint").alias("n_expected"), F.sum("s").cast("bigint").alias("n_stored"))
        .where(F.col("n_expected") == F.col("n_stored"))
    )
