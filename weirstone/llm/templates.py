"""Line dedup by a log-template tree: recurring templates across documents are dropped.

The tree has a fixed depth.  A line goes by its number of words, then by its
first ``DEPTH`` words, to a leaf; words with a digit are variable fields from
the start.  In a leaf, a word that ``MIN_DOCS`` documents have at its place is
a constant and every other word is a variable field, so lines that differ in
their fields get the same template.  A template counts if enough of its words
are constants (``SIMILARITY``) and ``MIN_DOCS`` documents have a line of it.
Its first line, by document and place, stays; all others are dropped, so a
group of copies does not lose its text altogether.

With ``exact=True`` a line of ``EXACT_WORDS`` words or more that stands word for
word, digits included, in ``EXACT_DOCS`` documents is dropped too, after its
first place.  ``MIN_DOCS`` then only tells constants from fields.  The first
line of a template is also the first of its copies, so both rules keep it.

Only leaves with enough documents can hold such a template, and counting leaves
takes a hash per line; words are spread out and counted only for the distinct
lines of those leaves.  Counts of one word at one place, which a third of all
lines may share, are pre-aggregated, and the join back is salted.

Defined results: a null text stays null, an empty one empty; lines without a
word are never dropped; lines are cut at line feeds only; a document counts
once for each of its distinct lines; rows that repeat count as one document and
get the same text; a row without id is a document, and the first; an empty
table gives no rows; other columns travel with their row, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import WORD, let, stored

DEPTH = 3
MIN_DOCS = 10
EXACT_DOCS = 2  # for lines that are equal word for word
EXACT_WORDS = 10  # shorter ones may be equal by chance
EXACT_SHARE = 60  # a text of which more percent of the words are such lines, but not all, is a near copy
SIMILARITY = 75  # per cent of the words without digits
FIELD = "<*>"
SALTS = 16


def _words(line: Column) -> Column:
    """The words of a line, those with a digit as a field."""
    words = F.regexp_extract_all(line, F.lit(WORD), F.lit(0))
    masked = F.transform(words, lambda w: F.when(w.rlike("[0-9]"), F.lit(FIELD)).otherwise(w))
    return F.when(line.rlike("[0-9]"), masked).otherwise(words)


def _leaf(words: Column) -> Column:
    return F.xxhash64(F.size(words), F.slice(words, 1, DEPTH))


def _lines(rows: DataFrame) -> DataFrame:
    """Lines with a word: document (``_id``, ``_mark``), place, words, leaf."""
    each = rows.select("_id", "_mark", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    worded = each.select("_id", "_mark", "_pos", _words(F.col("_line")).alias("_words")).where(F.size("_words") > 0)
    return worded.withColumn("_leaf", _leaf(F.col("_words")))


def _templates(lines: DataFrame) -> DataFrame:
    """Template (``_t``, ``_u``) of each distinct line (``_leaf``, ``_k``, ``_l``) that counts as one."""
    key = ["_leaf", "_k", "_l"]
    once = lines.select(*key, "_id", "_mark", "_words").dropDuplicates([*key, "_id", "_mark"])
    distinct = stored(once.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.first("_words").alias("_words")), "lines")
    spread = distinct.select(*key, "_n", F.posexplode("_words").alias("_at", "_word"))
    slots = spread.select(*key, "_n", F.xxhash64("_leaf", "_at", "_word").alias("_slot"), (F.col("_word") == FIELD).alias("_field"))
    constant = slots.groupBy("_slot").agg(F.sum("_n").alias("_docs")).where(F.col("_docs") >= MIN_DOCS)
    salted = constant.select("_slot", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit(True).alias("_constant"))
    marked = slots.withColumn("_salt", F.pmod("_k", F.lit(SALTS)).cast("int")).join(salted, ["_slot", "_salt"], "left")
    fixed = F.col("_constant").isNotNull()
    plain = ~F.col("_field")
    made = marked.groupBy(*key).agg(
        F.bit_xor(F.when(fixed, F.xxhash64(F.lit(1), "_slot")).otherwise(F.lit(0).cast("bigint"))).alias("_t"),
        F.bit_xor(F.when(fixed, F.xxhash64(F.lit(2), "_slot")).otherwise(F.lit(0).cast("bigint"))).alias("_u"),
        F.count_if(fixed & plain).alias("_constants"),
        F.count_if(plain).alias("_all"),
    )
    return made.where((F.col("_all") > 0) & (100 * F.col("_constants") >= SIMILARITY * F.col("_all"))).select(*key, "_t", "_u")


def _repeats(rows: DataFrame) -> DataFrame:
    """Places (``_id``, ``_mark``, ``_pos``) of long lines that an earlier document or place has word for word."""
    each = rows.select("_id", "_mark", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    worded = each.select("_id", "_mark", "_pos", F.regexp_extract_all("_line", F.lit(WORD), F.lit(0)).alias("_words"))
    key = ["_k", "_l"]
    long = worded.where(F.size("_words") >= EXACT_WORDS).select(
        "_id", "_mark", "_pos", F.xxhash64(F.lit(1), "_words").alias("_k"), F.xxhash64(F.lit(2), "_words").alias("_l")
    )
    several = stored(long.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= EXACT_DOCS).select("_k"), "copied")
    held = stored(long.join(several, "_k", "left_semi"), "copies")
    once = held.groupBy(*key, "_id", "_mark").agg(F.min("_pos").alias("_pos"))
    first = F.struct("_id", "_mark", "_pos")
    recurring = once.groupBy(*key).agg(F.count(F.lit(1)).alias("_docs"), F.min(first).alias("_first"))
    out = held.join(recurring.where(F.col("_docs") >= EXACT_DOCS), key).where(~first.eqNullSafe(F.col("_first")))
    return out.select("_id", "_mark", "_pos")


def _dropped(rows: DataFrame) -> DataFrame:
    """Places of the lines of recurring templates to drop, by document."""
    leaves = F.transform(F.split("_text", "\n"), lambda x: let(_words(x), _leaf))
    each = rows.select(F.explode(F.array_distinct(leaves)).alias("_leaf"))
    hot = stored(each.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS).select("_leaf"), "leaves")
    lines = _lines(rows).join(hot, "_leaf", "left_semi")
    named = lines.withColumns({"_k": F.xxhash64(F.lit(1), "_words"), "_l": F.xxhash64(F.lit(2), "_words")})
    held = stored(named, "held")
    key = ["_leaf", "_k", "_l"]
    placed = stored(
        held.select("_id", "_mark", "_pos", *key).join(_templates(held), key).select("_id", "_mark", "_pos", "_leaf", "_t", "_u"),
        "placed",
    )
    template = ["_leaf", "_t", "_u"]
    once = placed.groupBy(*template, "_id", "_mark").agg(F.min("_pos").alias("_pos"))
    first = F.struct("_id", "_mark", "_pos")
    recurring = once.groupBy(*template).agg(F.count(F.lit(1)).alias("_docs"), F.min(first).alias("_first"))
    out = placed.join(recurring.where(F.col("_docs") >= MIN_DOCS), template).where(~first.eqNullSafe(F.col("_first")))
    return _listed(out.select("_id", "_mark", "_pos"), "_drop")


def _listed(places: DataFrame, name: str) -> DataFrame:
    return places.groupBy("_id", "_mark").agg(F.array_sort(F.collect_set("_pos")).alias(name))


def _near_copy(lines: Column, places: Column) -> Column:
    """True if the lines at ``places`` hold more than ``EXACT_SHARE`` percent of all words, but not all."""
    sizes = F.transform(lines, lambda x: F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    shares = let(
        sizes, lambda n: F.struct(total(F.transform(places, lambda i: F.get(n, i))).alias("gone"), total(n).alias("all"))
    )
    return let(shares, lambda s: (100 * s["gone"] > EXACT_SHARE * s["all"]) & (s["gone"] < s["all"]))


def drop_templates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exact: bool = False
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``text`` without the dropped lines, ``n_lines``, ``n_dropped``.

    ``exact``: drop long lines that are repeated word for word from ``EXACT_DOCS`` documents on.  A
    text of which they are more than ``EXACT_SHARE`` percent of the words, but not all, keeps them:
    it is a near copy, which a search for near duplicates must see whole.
    """
    text = F.col(text_col).cast("string")
    keys = (F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_mark"), text.alias("_text"))
    dropped = stored(_dropped(docs.select(*keys)), "dropped")
    rows = docs.select(F.struct("*").alias("row"), *keys).alias("d")
    same = F.expr("d._id <=> x._id AND d._mark = x._mark")
    joined = rows.join(dropped.alias("x"), same, "left").select("row", "d._id", "d._mark", "_text", "_drop")
    if exact:
        repeats = stored(_listed(_repeats(docs.select(*keys)), "_exact"), "repeats")
        joined = joined.alias("d").join(repeats.alias("x"), same, "left").select("row", "_text", "_drop", "_exact")
        line = F.split("_text", "\n")
        own = F.when(~_near_copy(line, F.col("_exact")), F.col("_exact"))
        both = F.array_union(F.coalesce("_drop", F.array().cast("array<int>")), own)
        joined = joined.withColumn("_drop", F.coalesce(F.when(F.col("_exact").isNotNull(), both), "_drop"))
    lines = joined.select("row", "_text", "_drop", F.split("_text", "\n").alias("_lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    return lines.select(
        "row",
        F.when(F.col("_drop").isNull(), F.col("_text"))
        .otherwise(F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n"))
        .alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
