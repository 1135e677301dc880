"""Table profiles and source-against-target reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.functions.canonical import checksum, row_hash, summands, wide_sum
from weirstone.operators.setops import row_difference
from weirstone.session import materialise


def numeric_fields(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def table_checksum(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Row count and checksum, independent of row order; fractions exact unless ``digits`` says otherwise."""
    hashed = df.select(row_hash(df.schema.fields, digits).alias("h"))
    return hashed.agg(F.count(F.lit(1)).alias("row_count"), checksum(F.col("h")).alias("checksum"))


def numeric_profile(df: DataFrame, sum_digits: int = 2) -> DataFrame:
    """Sum, minimum and maximum of every numeric column, in one scan.

    Sums of fractions are whole counts of the ``sum_digits``-th decimal place,
    so they do not depend on the order of addition; minimum and maximum are of
    the values as they are, NaN above all.  ``n_not_summed`` counts what a sum
    cannot hold: NaN, infinities and numbers of 1e28 counts or more.
    """
    fields = numeric_fields(df)
    values = df.select(*_profile_columns(fields, sum_digits))
    row = values.agg(*_profile_aggs(fields))
    return row.select(F.explode(F.array(*_profile_structs(fields))).alias("r")).select("r.*")


def _profile_columns(fields: Sequence[T.StructField], digits: int) -> list[Column]:
    columns = []
    for i, f in enumerate(fields):
        small, large, lost = summands(f, digits)
        columns += [F.col(f"`{f.name}`").alias(f"v{i}"), small.alias(f"w{i}")]
        if large is not None:
            columns += [large.alias(f"x{i}"), lost.alias(f"y{i}")]
    return columns


def _fractional(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.FractionalType)


def _profile_aggs(fields: Sequence[T.StructField]) -> list[Column]:
    aggs = []
    for i, f in enumerate(fields):
        total = wide_sum(F.col(f"w{i}"))
        lost = F.lit(0).cast("bigint")
        if _fractional(f):
            large = F.sum(f"x{i}")
            total = F.when(large.isNull(), total).otherwise(F.coalesce(total, F.lit(0)) + large)
            lost = F.count_if(f"y{i}")
        aggs += [
            total.cast("decimal(38,0)").cast("string").alias(f"s{i}"),
            F.min(f"v{i}").cast("string").alias(f"lo{i}"),
            F.max(f"v{i}").cast("string").alias(f"hi{i}"),
            lost.alias(f"n{i}"),
        ]
    return aggs


def _profile_structs(fields: Sequence[T.StructField]) -> list[Column]:
    return [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col(f"s{i}").alias("sum_value"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            F.col(f"n{i}").alias("n_not_summed"),
        )
        for i, f in enumerate(fields)
    ]


def check_table(df: DataFrame, name: str, digits: int | None = None, sum_digits: int = 2) -> DataFrame:
    """Count, checksum and numeric profile of a table in a single scan.

    One row; ``aggregates`` maps ``sum_x``, ``min_x`` and ``max_x`` to text, and
    ``not_summed_x`` for fractions.
    """
    fields = numeric_fields(df)
    values = df.select(row_hash(df.schema.fields, digits).alias("__h"), *_profile_columns(fields, sum_digits))
    row = values.agg(
        F.count(F.lit(1)).alias("row_count"), checksum(F.col("__h")).alias("checksum"), *_profile_aggs(fields)
    )
    pairs = []
    for i, f in enumerate(fields):
        labels = [("sum", f"s{i}"), ("min", f"lo{i}"), ("max", f"hi{i}")]
        for label, col in labels + ([("not_summed", f"n{i}")] if _fractional(f) else []):
            pairs.append(F.struct(F.lit(f"{label}_{f.name}").alias("key"), F.col(col).cast("string").alias("value")))
    entry_list = F.array(*pairs) if pairs else F.array().cast("array<struct<key:string,value:string>>")
    return row.select(
        F.lit(name).alias("table_name"),
        "row_count",
        "checksum",
        F.map_from_entries(entry_list).alias("aggregates"),
        (F.col("row_count") > 0).alias("ok"),
    )


def check_tables(tables: Mapping[str, DataFrame], digits: int | None = None) -> DataFrame:
    """One check row per table, all in one job."""
    return reduce(DataFrame.unionByName, [check_table(df, n, digits) for n, df in sorted(tables.items())])


def compare_checks(source: DataFrame, target: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Two-sided comparison of check rows, one row per table of either side.

    ``tolerance`` is the relative difference that numeric aggregates may have.
    """
    s = source.select("table_name", F.struct("row_count", "checksum", "aggregates").alias("s"))
    t = target.select("table_name", F.struct("row_count", "checksum", "aggregates").alias("t"))
    both = s.join(t, "table_name", "full_outer")

    def close(k: Column) -> Column:
        a = F.try_element_at(F.col("s.aggregates"), k)
        b = F.try_element_at(F.col("t.aggregates"), k)
        if tolerance == 0.0:
            return a.eqNullSafe(b)
        x, y = a.cast("double"), b.cast("double")
        return a.eqNullSafe(b) | F.coalesce(
            F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y)), F.lit(False)
        )

    keys = F.array_union(
        F.coalesce(F.map_keys(F.col("s.aggregates")), F.array().cast("array<string>")),
        F.coalesce(F.map_keys(F.col("t.aggregates")), F.array().cast("array<string>")),
    )
    count_ok = F.col("s.row_count").eqNullSafe(F.col("t.row_count"))
    sum_ok = F.col("s.checksum").eqNullSafe(F.col("t.checksum"))
    agg_ok = F.forall(keys, close)
    return both.select(
        "table_name",
        F.col("s.row_count").alias("source_rows"),
        F.col("t.row_count").alias("target_rows"),
        count_ok.alias("count_ok"),
        sum_ok.alias("checksum_ok"),
        agg_ok.alias("aggregates_ok"),
        (count_ok & sum_ok & agg_ok).alias("ok"),
    )


def compare_keyed(source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full compare of two keyed result sets: match, diff, source_only, target_only.

    Both sides meet in one aggregation rather than an outer join, so a repeated
    key is found (``duplicate_key``) and not multiplied.
    """
    row = F.struct(*[F.col(v) for v in values])
    sides = source.select(*keys, row.alias("s"), F.lit(None).alias("t"), F.lit(1).alias("ns"), F.lit(0).alias("nt"))
    sides = sides.withColumn("t", F.lit(None).cast(sides.schema["s"].dataType))
    others = target.select(*keys, F.lit(None).alias("s"), row.alias("t"), F.lit(0).alias("ns"), F.lit(1).alias("nt"))
    others = others.withColumn("s", F.lit(None).cast(others.schema["t"].dataType)).select(*sides.columns)
    merged = sides.unionByName(others).groupBy(*keys).agg(
        F.min("s").alias("s"), F.min("t").alias("t"), F.sum("ns").alias("ns"), F.sum("nt").alias("nt")
    )
    status = (
        F.when((F.col("ns") > 1) | (F.col("nt") > 1), "duplicate_key")
        .when(F.col("nt") == 0, "source_only")
        .when(F.col("ns") == 0, "target_only")
        .when(F.col("s").eqNullSafe(F.col("t")), "match")
        .otherwise("diff")
    )
    return merged.select(
        *keys,
        *[F.col(f"s.`{v}`").alias(f"source_{v}") for v in values],
        *[F.col(f"t.`{v}`").alias(f"target_{v}") for v in values],
        status.alias("status"),
    )


def in_sample(key: Column, hex_bound: str) -> Column:
    """The same part of the keys on every run and side: MD5 prefix below a bound."""
    return F.substring(F.md5(key.cast("string")), 1, len(hex_bound)) < hex_bound


def value_parity(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], hex_bound: str | None = None
) -> DataFrame:
    """Per column: keys compared and values that differ, on all keys or a fixed sample.

    Both sides meet in one aggregation, so keys of one side only and repeated
    keys are counted too; a key counts as compared if each side has it once.
    """
    if hex_bound is not None:
        source = source.where(in_sample(F.col(key), hex_bound))
        target = target.where(in_sample(F.col(key), hex_bound))

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in columns])
        kind = df.select(row.alias("r")).schema["r"].dataType
        none = F.lit(None).cast(kind)
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        values = {own: row, other: none, f"n{own}": one, f"n{other}": zero}
        return df.select(F.col(key), *[values[c].alias(c) for c in ("s", "t", "ns", "nt")])

    rows = side(source, "s", "t").unionByName(side(target, "t", "s")).groupBy(key).agg(
        F.min("s").alias("s"), F.min("t").alias("t"), F.sum("ns").alias("ns"), F.sum("nt").alias("nt")
    )
    both = (F.col("ns") == 1) & (F.col("nt") == 1)
    diffs = [
        F.count_if(both & ~F.col(f"s.`{c}`").eqNullSafe(F.col(f"t.`{c}`"))).alias(f"d{i}") for i, c in enumerate(columns)
    ]
    row = rows.agg(
        F.count_if(both).alias("compared"),
        F.count_if(F.col("nt") == 0).alias("source_only"),
        F.count_if(F.col("ns") == 0).alias("target_only"),
        F.count_if((F.col("ns") > 1) | (F.col("nt") > 1)).alias("duplicate_keys"),
        *diffs,
    )
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("mismatches")) for i, c in enumerate(columns)]
    kept = ("compared", "source_only", "target_only", "duplicate_keys")
    return row.select(*kept, F.explode(F.array(*items)).alias("r")).select("r.*", *kept)


def control_total(mart: DataFrame, measure: str, rows: DataFrame) -> DataFrame:
    """One row: sum of a mart measure against the count of its source rows."""
    sides = mart.agg(F.sum(measure).cast("bigint").alias("mart_total")).select(
        "mart_total", F.lit(None).cast("bigint").alias("source_rows")
    ).unionByName(
        rows.agg(F.count(F.lit(1)).alias("source_rows")).select(
            F.lit(None).cast("bigint").alias("mart_total"), "source_rows"
        )
    )
    both = sides.agg(F.max("mart_total").alias("mart_total"), F.max("source_rows").alias("source_rows"))
    return both.withColumn("ok", F.coalesce(F.col("mart_total"), F.lit(0)) == F.col("source_rows"))


def stable_runs(runs: DataFrame, order: str, measure: str, max_spread: int, series: Sequence[str], n: int = 3) -> DataFrame:
    """Spread of a measure over the last ``n`` runs, and whether it is stable.

    ``runs`` holds one row per run of a series, so a window never spans more
    rows than a series has runs.
    """
    w = Window.partitionBy(*series).orderBy(order).rowsBetween(1 - n, 0)
    spread = (F.max(measure).over(w) - F.min(measure).over(w)).alias("spread")
    seen = F.count(measure).over(w).alias("n_runs")
    out = runs.select("*", spread, seen)
    return out.withColumn("stable", (F.col("n_runs") == n) & (F.col("spread") <= max_spread))


def check_summary(checks: DataFrame) -> DataFrame:
    """Status row per check, as a reader of the report sees it."""
    return checks.select(
        "table_name",
        "row_count",
        "checksum",
        F.size("aggregates").cast("bigint").alias("n_aggregates"),
        F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"),
    )


def check_verdict(checks: DataFrame) -> DataFrame:
    """One row over all checks: how many, how many failed, and whether all passed."""
    failed = F.count_if(~F.coalesce("ok", F.lit(False)))
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"),
        failed.alias("n_failed"),
        F.when((failed == 0) & (F.count(F.lit(1)) > 0), "PASS").otherwise("FAIL").alias("status"),
    )


COARSE, FINE = "bucket", "_fine"


def land_by_key(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> T.StructType:
    """Write a table into folders by bucket of its key, for ``drilldown``; its schema."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    df.withColumn(COARSE, bucket).hint("rebalance", COARSE).write.partitionBy(COARSE).parquet(path)
    return df.schema


def _by_bucket(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], fine: int) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(COARSE, T.IntegerType())])
    rows = spark.read.schema(full).parquet(path)
    return rows.withColumn(FINE, F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(fine)).cast("int"))


def bucket_checks(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, keys: Sequence[str], fine: int = 256
) -> DataFrame:
    """The buckets in which two tables landed by key differ: the lower level of a tree of checksums.

    A bucket has the row counts and checksums of both sides; equal ones are left out.
    """
    sides = []
    for side, path in enumerate(paths):
        rows = _by_bucket(spark, path, schema, keys, fine)
        hashed = rows.select(COARSE, FINE, row_hash(schema.fields).alias("h"))
        part = hashed.groupBy(COARSE, FINE).agg(F.count(F.lit(1)).alias("n"), checksum(F.col("h")).alias("c"))
        sides.append(part.select(COARSE, FINE, F.lit(side).alias("side"), F.struct("n", "c").alias("check")))
    both = sides[0].unionByName(sides[1]).groupBy(COARSE, FINE).agg(
        F.max(F.when(F.col("side") == 0, F.col("check"))).alias("source"),
        F.max(F.when(F.col("side") == 1, F.col("check"))).alias("target"),
    )
    return both.where(~F.col("source").eqNullSafe(F.col("target")))


def drilldown(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    schema: T.StructType,
    keys: Sequence[str],
    fine: int = 256,
) -> DataFrame:
    """Rows in which two tables landed by key differ, as ``setops.row_difference`` gives them.

    Both are read once for the checksums of small buckets.  Only the folders of
    buckets that differ are read again, and of these only the rows of differing
    small buckets are compared.
    """
    paths = (source_path, target_path)
    unlike = materialise(bucket_checks(spark, paths, schema, keys, fine).select(COARSE, FINE), "unlike")
    folders = [r[0] for r in unlike.select(COARSE).distinct().collect()]  # at most the number of folders
    sides = []
    for path in paths:
        rows = _by_bucket(spark, path, schema, keys, fine).where(F.col(COARSE).isin(folders))
        sides.append(rows.join(unlike, [COARSE, FINE], "left_semi").select(*schema.names))
    return row_difference(*sides)
