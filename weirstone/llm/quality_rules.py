"""Quality rules: base counts of a text, and a log-likelihood ratio of hashed word n-grams.

The words and word pairs of a text are hashed into ``2 ** BITS`` buckets.  Two
multinomials over the buckets are counted over all documents: one of the
trusted ones (label quality 1), one of the raw corpus.  A document's score is
the mean over its n-grams of ``log(trusted / raw)``: length does not matter.
The log ratio of a bucket is rounded to a multiple of ``2 ** -SCALE_BITS``, so
sums are exact whole numbers, and every document is kept or rejected by the
same comparison wherever and whenever it runs.

The trusted set is every document labelled 1, however many: their ids are
joined to the documents, and no side is hinted.  The table of buckets has a
fixed size and goes out as a constant.

Defined results: a null or empty text has no words and fails the base rules;
with no trusted documents all ratios are 0 and the base rules decide alone; a
null id is never trusted; rows that repeat are scored each; an empty table
gives no rows; other columns travel with their row, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import SPACES, let, stored

BITS = 14
PRIOR = 8  # added to each bucket's count in both multinomials
SCALE_BITS = 20
MIN_MEAN = -0.08  # nats per n-gram
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
SYMBOLS = "#*$%&|<>"
WINDOW = 3


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def repeated_words(tokens: Column) -> Column:
    """Words inside three-word windows that are found twice or more.

    Only texts with a repeated window sort their windows; equal hashes then
    stand side by side, and each window found twice covers its three words.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        last = F.size(hashes) - 1

        def twice(all_: Column) -> Column:
            def beside(x: Column, k: Column) -> Column:
                same = lambda step: F.coalesce(F.get(all_, k + step)["h"] == x["h"], F.lit(False))
                return same(-1) | F.when(k < last, same(1)).otherwise(F.lit(False))

            return F.filter(all_, beside)

        starts = F.transform(let(placed, twice), lambda x: x["i"])
        spread = F.flatten(F.transform(starts, lambda i: F.array(*(i + k for k in range(WINDOW)))))
        return F.size(F.array_distinct(spread))

    windows = lambda t: F.transform(
        F.sequence(F.lit(0), F.size(t) - WINDOW), lambda i: F.xxhash64(*(F.get(t, i + k) for k in range(WINDOW)))
    )
    count = let(
        tokens,
        lambda t: F.when(
            F.size(t) > WINDOW,
            let(
                windows(t),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
            ),
        ).otherwise(F.lit(0)),
    )
    return count.cast("bigint")


def _grams(docs: DataFrame, keep: list[str]) -> DataFrame:
    """A row per word of ``_words``, none for a text without, with the buckets of the word and of its pair with the next."""
    pairs = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, 1 << 30).alias("b"))
    each = docs.select(*keep, F.explode_outer(pairs).alias("g"))
    bucket = lambda text: F.pmod(F.crc32(text.cast("binary")), F.lit(1 << BITS)).cast("int")
    return each.select(
        *keep,
        F.when(F.col("g.a").isNotNull(), bucket(F.col("g.a"))).alias("_one"),
        F.when(F.col("g.b").isNotNull(), bucket(F.concat("g.a", F.lit(" "), "g.b"))).alias("_two"),
    )


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The ids of all documents labelled 1, each once."""
    return labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("bigint").alias("_trusted")).dropna().distinct()


def ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log ratios by bucket, as whole numbers: ``_bucket``, ``_ratio``; ``2 ** BITS`` rows."""
    # the join may move the rows, so texts are cut into words after it
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # a shuffle of both sides at every size: what moves is in proportion to the texts, and they are not sorted
    trusted = trusted_ids(labels).hint("shuffle_hash")
    marked = rows.join(trusted, F.col("_id") == F.col("_trusted"), "left").select(
        F.col("_trusted").isNotNull().cast("bigint").alias("_good"), words(F.col("_text")).alias("_words")
    )
    grams = _grams(marked, ["_good"])
    # both kinds of n-gram are counted before they meet, else each row would be there twice
    counts = None
    for name in ("_one", "_two"):
        part = grams.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_bucket"))
        part = part.agg(F.count(F.lit(1)).alias("_raw"), F.sum("_good").alias("_target"))
        counts = part if counts is None else counts.unionByName(part)
    every = docs.sparkSession.range(1 << BITS).select(F.col("id").cast("int").alias("_bucket"))
    full = (
        every.join(counts.groupBy("_bucket").agg(F.sum("_raw").alias("_raw"), F.sum("_target").alias("_target")), "_bucket", "left")
        .fillna(0)
    )
    total = full.agg(F.sum("_raw").alias("_all_raw"), F.sum("_target").alias("_all_target"))
    prior = PRIOR << BITS
    share = lambda n, all_: (F.col(n) + PRIOR) / (F.col(all_) + prior)
    ratio = F.when(
        F.col("_all_target") > 0, F.log(share("_target", "_all_target")) - F.log(share("_raw", "_all_raw"))
    ).otherwise(0.0)
    return full.join(F.broadcast(total)).select("_bucket", F.round(ratio * (1 << SCALE_BITS)).cast("bigint").alias("_ratio"))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The ratios of all buckets as a constant array: a model of fixed size, a few dozen kB."""
    table = stored(ratios(docs, labels, id_col, text_col), "ratios")
    listed = F.array_sort(F.collect_list(F.struct("_bucket", "_ratio")))
    values = table.agg(F.array_join(F.transform(listed, lambda x: x["_ratio"].cast("string")), ",")).first()[0]
    return F.split(F.lit(values), ",").cast("array<bigint>")


def _log_ratio(tokens: Column, model: Column) -> Column:
    """Sum of the ratios of all words and pairs."""
    pairs = F.zip_with(tokens, F.slice(tokens, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.aggregate(
        F.concat(tokens, pairs),
        F.lit(0).cast("bigint"),
        lambda acc, g: acc
        + F.coalesce(F.get(model, F.pmod(F.crc32(g.cast("binary")), F.lit(1 << BITS)).cast("int")), F.lit(0)),
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_mean: float = MIN_MEAN,
) -> DataFrame:
    """Counts and verdict of every row: ``row`` (all its columns), the counts, ``base_failed``, ``score``, ``kept``."""
    model = fitted(docs, labels, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tokens = docs.select(F.struct("*").alias("row"), text.alias("_text"), words(text).alias("_words"))
    counted = tokens.select(
        "row",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        repeated_lines(F.col("_text")).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        _log_ratio(F.col("_words"), model).alias("_sum"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    enough = F.col("_sum") >= F.lit(round(min_mean * (1 << SCALE_BITS))) * grams
    return counted.withColumns(
        {
            "base_failed": base_failed,
            "score": F.when(grams > 0, F.col("_sum") / grams / (1 << SCALE_BITS)),
            "kept": ~base_failed & enough,
        }
    ).drop("_sum")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return judge(docs, labels, id_col, text_col).where("kept").select("row.*")
