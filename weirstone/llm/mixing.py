"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words.  The sources, by code point with
null last, weigh 1, 2, 3 and so on in turn and share all words by weight; a
target stops at ``MAX_EPOCHS`` times its source's words, and what is left over
is shared again among the others.  Every document of a source is expected
``target / source words`` times.  Within its source, in order of size, these
expectations are summed up from one offset in [0, 1) that is fixed by seed and
source; a document is taken once for each whole number that its sum crosses.
Going by size spreads what is taken evenly over short and long documents, so
the words taken miss the target by a few documents at most.

The order is a range sort (source, size, id): a source that holds most rows is
cut into many ranges, and only the row count of each range meets in one place.
Whole rows are not sorted or stored: ids, sizes and hashes of texts are ranked,
and the rows, shuffled once, get their ranks by a join.

Defined results: a null or empty text has size 0; null is a source of its own;
a source without words has target 0 and gives no documents; rows that repeat
count as documents of their own, numbered where they meet their first rank; an empty table gives no rows; other columns
travel with their row, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.llm.common import WORD, stored
from weirstone.operators.ordering import global_rank

MAX_EPOCHS = 3
WEIGHTS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: words, documents before it, target, expected copies, offset.

    With the sources in order of limit per unit of weight, the share per weight
    that would be left if all before were at their limit rises up to the first
    source that stays below its own, and falls after: its maximum is the share.
    """
    sums = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    weighed = sums.withColumns(
        {
            "_weight": 1 + (F.row_number().over(by_name) - 1) % WEIGHTS,
            "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_limit": MAX_EPOCHS * F.col("source_size"),
        }
    )
    by_ratio = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").asc_nulls_last())
    filled = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(filled), F.lit(0))
    weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(filled), F.lit(0))
    shared = weighed.withColumn("_left", left / weight).withColumn("_share", F.max("_left").over(everything))
    target = F.least(F.col("_limit").cast("double"), F.col("_share") * F.col("_weight"))
    digits = F.substring(F.md5(F.concat(F.lit(SEED), F.coalesce(F.concat(F.lit(":"), "_source"), F.lit("")))), 1, 8)
    return shared.select(
        "_source",
        "source_size",
        "_before",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("_rate"),
        (F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 32))).alias("_offset"),
    )


def _copies(place: Column, rate: Column, offset: Column) -> Column:
    steps = F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset)
    # the bound holds by itself but for the last bit of a product
    return F.least(steps, F.lit(MAX_EPOCHS)).cast("bigint").alias("copies")


def _placed(sized: DataFrame, order: list[Column]) -> DataFrame:
    """The rows of ``sized`` with their place in their source, from 1, and the columns of ``targets``."""
    sources = stored(targets(sized), "targets")
    ranked = global_rank(sized, order, "_rank", unique=True)
    named = sources.withColumnRenamed("_source", "_of")
    rows = ranked.join(named, F.col("_source").eqNullSafe(F.col("_of")))
    return rows.withColumn("_place", F.col("_rank") - F.col("_before"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(source_col).cast("string").alias("_source"),
        word_count(F.col(text_col)).alias("_size"),
        F.col(id_col).alias("_id"),
    ]


def allot(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Copies of each document: ``id``, ``size``, ``source_size``, ``target``, ``copies``."""
    sized = stored(docs.select(*_sized(docs, id_col, text_col, source_col)), "sizes")
    rows = _placed(sized, [F.col("_source").asc_nulls_last(), F.col("_size"), F.col("_id")])
    return rows.select(
        F.col("_id").alias("id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        _copies(F.col("_place"), F.col("_rate"), F.col("_offset")),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows, with all columns of ``docs``; a document taken twice is there twice.

    Rows with one id, source, size and text have neighbouring places; the join
    brings the first of these, and the rows are numbered from it.
    """
    # one column that is never null; the window goes by that of the stored side, which the join needs not cast, and so by its shuffle
    key = F.struct(*_sized(docs, id_col, text_col, source_col), F.xxhash64(F.col(text_col)).alias("_mark")).alias("_key")
    keyed = docs.select(key, F.struct("*").alias("row"))
    sized = stored(keyed.select("_key.*"), "sizes")
    placed = _placed(sized, [F.col("_source").asc_nulls_last(), F.col("_size"), F.col("_id"), F.col("_mark")])
    first = placed.groupBy(F.struct("_source", "_size", "_id", "_mark").alias("_of")).agg(
        F.min("_place").alias("_first"), F.first("_rate").alias("_rate"), F.first("_offset").alias("_offset")
    )
    # always merged: what it moves is in proportion to the rows, at every size
    rows = keyed.join(first.hint("merge"), F.col("_key") == F.col("_of"))
    number = F.row_number().over(Window.partitionBy("_of").orderBy("_of"))
    copies = _copies(F.col("_first") + number - 1, F.col("_rate"), F.col("_offset"))
    taken = rows.select("row", copies).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
