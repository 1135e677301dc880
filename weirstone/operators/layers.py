"""Layers of a warehouse batch: source load, facts, daily aggregate, mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_source(source: DataFrame, columns: Sequence[str], condition: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Project and filter a source; ``condition`` takes named parameters.

    The parameters become literals, so the filter reaches the file scan.
    """
    spark = source.sparkSession
    text = f"SELECT {', '.join(columns)} FROM {{source}} WHERE {condition}"
    return spark.sql(text, args=dict(args or {}), source=source)


def join_facts(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of facts with dimensions on (fact key, dimension key), in order."""
    out = facts
    for dim, left, right in dims:
        out = out.join(dim, F.col(left) == F.col(right), "inner")
    return out


def daily_rollup(
    facts: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], totals: Mapping[str, Column], approximate: bool = False
) -> DataFrame:
    """Roll facts up: distinct counts (name -> column) and sums (name -> measure).

    Exact distinct counts reduce each (key, value) pair before the shuffle;
    ``approximate`` replaces them by sketches of fixed size.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [count(F.col(c)).alias(n) for n, c in distinct.items()]
    aggs += [F.sum(m).cast("bigint").alias(n) for n, m in totals.items()]
    return facts.groupBy(*keys).agg(*aggs)


def chain_rollup(
    facts: DataFrame,
    keys: Sequence[str],
    chain: Sequence[tuple[str, str]],
    others: Mapping[str, str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Exact distinct counts and sums without a copy of each row per count.

    ``chain`` names columns from fine to coarse as (name, column), each value of
    which has one value of the next (an order has one buyer).  Rows become rows
    per finest value, these rows per next value, and so on: each step counts
    the rows of the one before and is smaller.  ``others`` are counted from
    their own distinct pairs.  Null values do not count.
    """
    keys = list(keys)
    columns = [c for _, c in chain]
    sums = {n: f"_s{i}" for i, n in enumerate(totals)}
    level = facts.groupBy(*keys, *columns).agg(F.count(F.lit(1)), *[F.sum(m).alias(sums[n]) for n, m in totals.items()])
    counts: list[str] = []
    for i, (name, column) in enumerate(chain):
        rest = columns[i + 1 :]
        here = F.count(F.col(column)).alias(f"_n{i}")
        kept = [F.sum(c).alias(c) for c in (*counts, *sums.values())]
        level = level.groupBy(*keys, *rest).agg(here, *kept)
        counts.append(f"_n{i}")
    out = level.select(
        *keys,
        *[F.col(c).cast("bigint").alias(n) for c, (n, _) in zip(counts, chain)],
        *[F.col(c).cast("bigint").alias(n) for n, c in sums.items()],
    )
    for name, column in others.items():
        pairs = facts.select(*keys, column).distinct().groupBy(*keys).agg(F.count(column).alias(name))
        renamed = pairs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], name)
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        out = out.join(renamed, same).drop(*[f"_k{i}" for i in range(len(keys))])
    return out


def daily_sketches(facts: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], bits: int = 12) -> DataFrame:
    """One sketch of fixed size per key and counted column, to be stored with the day.

    The relative standard error of an estimate is about 0.83 / sqrt(2 ** bits).
    """
    return facts.groupBy(*keys).agg(*[F.hll_sketch_agg(c, bits).alias(n) for n, c in distinct.items()])


def merged_counts(sketches: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Distinct counts over any coarser keys by union of stored sketches; no fact is read again."""
    return sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def segment_count(df: DataFrame, condition: Column, key: str, counted: str, name: str = "num") -> DataFrame:
    """Filtered count of non-null values per segment."""
    return df.where(condition).groupBy(key).agg(F.count(counted).alias(name))


def conditional_counts(df: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows per key that meet each condition."""
    return df.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def class_counts(df: DataFrame, key: str, excluded: Sequence[str] = ()) -> DataFrame:
    """Rows per class without the excluded classes."""
    rows = df.where(~F.col(key).isin(*excluded)) if excluded else df
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
