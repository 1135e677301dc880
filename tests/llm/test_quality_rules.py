import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cases import WORD, clashing, frame, hard_texts, prose
from weirstone.llm import quality_rules as rules

LABELS = "doc_id bigint, quality int, toxic int"


def grams(text):
    w = WORD.findall(text or "")
    return w, [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]


def brute(rows, trusted):
    size = 1 << rules.BITS
    raw, good = Counter(), Counter()
    hashed = lambda g: zlib.crc32(g.encode()) % size
    for i, text in rows:
        for g in grams(text)[1]:
            raw[hashed(g)] += 1
            good[hashed(g)] += i in trusted
    n, m = sum(raw.values()), sum(good.values())
    prior = rules.PRIOR * size

    def ratio(b):
        if not m:
            return 0
        value = math.log((good[b] + rules.PRIOR) / (m + prior)) - math.log((raw[b] + rules.PRIOR) / (n + prior))
        return math.floor(abs(value * 2**rules.SCALE_BITS) + 0.5) * (1 if value > 0 else -1)

    out = []
    for i, text in rows:
        w, g = grams(text)
        t = text or ""
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        total = sum(ratio(hashed(x)) for x in g)
        kept = not failed and total >= round(rules.MIN_MEAN * 2**rules.SCALE_BITS) * len(g)
        out.append(
            (i, len(w), sum(map(len, w)), sum(c in rules.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered), failed, kept)
        )
    return sorted(out)


def run(df, labels):
    rows = rules.judge(df, labels).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    return sorted(tuple(r) for r in rows.collect())


def test_against_brute_force(spark):
    texts = hard_texts()
    df = frame(spark, texts)
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (10, 0, 0), (11, 0, 1), (None, 1, 0)], LABELS)
    expected = brute(list(enumerate(texts, 1)), {1, 4})
    assert run(df, labels) == expected
    assert run(clashing(df), labels) == expected


def test_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert run(df, labels) == brute(rows, good)


def test_every_trusted_document_counts(spark):
    ids = spark.range(1, 30_001)
    labels = ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert rules.trusted_ids(labels.union(labels)).count() == 30_000
    # with every document trusted, both multinomials are the same
    texts = [f"{prose(800 + k, 60)} w{k}" for k in range(40)]
    assert rules.ratios(frame(spark, texts), labels).where("_ratio <> 0").count() == 0


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], LABELS)
    assert run(frame(spark, []), none) == []
    assert run(frame(spark, hard_texts()), none) == brute(list(enumerate(hard_texts(), 1)), set())


def test_stage_keeps_columns(spark):
    df = clashing(frame(spark, hard_texts()))
    out = rules.keep_good(df, spark.createDataFrame([], LABELS))
    assert out.columns == df.columns
    assert out.where(F.col("text").isNull()).count() == 0
