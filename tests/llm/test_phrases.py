import random
import re
from collections import Counter

import pytest

from cases import clashing, frame, hard_texts
from weirstone.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000):
    """``rows`` are pairs of language and text."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed=1, many=80):
    rng = random.Random(seed)
    words = ["of", "The", "big", "ähre", "漢字", "\x00x", "a\x1fb", "red", "fox"]
    out = hard_texts()
    for _ in range(many):
        pieces = [" ".join(rng.choices(words, weights=[9, 8, 5, 3, 2, 1, 1, 4, 4], k=rng.randint(0, 12))) for _ in range(6)]
        out.append("".join(p + rng.choice([". ", "\n", ",", "\t", " ; ", "!"]) for p in pieces))
    return out + ["the red fox jumps over. " * 30, "b b b b b b b " * 5]


def langs(df):
    from pyspark.sql import functions as F

    return df.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").when(F.col("doc_id") % 3 == 1, "en"))


def run(df, **given):
    return sorted(map(tuple, phrases.collocations(df, **given).collect()))


@pytest.mark.parametrize("chunk, top", [(300, 2000), (8 << 20, 7)])
def test_against_brute_force(spark, monkeypatch, chunk, top):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    df = clashing(langs(frame(spark, texts())))
    rows = [(r.lang, r.text) for r in df.collect()]
    expected = brute(rows, 4, top=top)
    assert run(df, min_count=4, top=top) == expected
    assert len({r[0] for r in expected}) == 3


def test_many_small_buckets(spark, monkeypatch):
    for name, many in (("CHUNK_BYTES", 500), ("BUCKET_ROOT", 1), ("BUCKET_LEAST", 4), ("BUCKET_MOST", 16)):
        monkeypatch.setattr(phrases, name, many)
    df = langs(frame(spark, texts(3, 40)))
    assert run(df, min_count=3) == brute([(r.lang, r.text) for r in df.collect()], 3)


def test_a_phrase_of_a_chunk_is_moved_once_in_few_bytes(spark, monkeypatch):
    """Rows of chunk, place and parts, moved for the count and again for the join, took 20 bytes and more."""
    rng, found = random.Random(5), {}
    keep = phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df, label: found.setdefault(label, keep(df, label)))
    words = [f"w{k}" for k in range(400)]
    df = frame(spark, [" ".join(rng.choices(words, k=20_000)) for _ in range(8)], ("a",)).coalesce(1)
    phrases.mine(df, 2, 2)
    pairs = found["occurrences-2"]
    listed = pairs.selectExpr("sum(listed)").first()[0]
    assert listed > 50_000
    counted = phrases._count(pairs, 2, 2)
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    blocks = pairs.select("chunk", "lang", "words", "phrases").mapInArrow(phrases._dealt(2, 4), phrases._BLOCK)
    assert blocks.selectExpr("sum(length(block))").first()[0] < 8 * listed


def test_repeated_rows_and_a_minimum_nothing_reaches(spark):
    df = langs(frame(spark, texts(2, 20)))
    twice = df.unionByName(df)
    assert run(twice, min_count=4) == brute([(r.lang, r.text) for r in twice.collect()], 4)
    assert run(df, min_count=10**6) == []


def test_empty_tables(spark):
    df = frame(spark, ["a b a b"])
    assert run(df.limit(0), min_count=1) == []
    assert run(frame(spark, [None, "", " . "]), min_count=1) == []


def test_exact_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 1 << 43
    row = spark.range(1).select(
        F.lit(big - 1).alias("a"), F.lit(big + 7).alias("n"),
        F.array(F.lit(big - 1).cast("bigint"), F.lit(big - 1).cast("bigint")).alias("heads"),
        F.array(F.lit(big + 3).cast("bigint"), F.lit(big - 1).cast("bigint")).alias("tails"),
    )
    cut = row.select(phrases._lowest_cut(2).alias("c")).first().c
    assert cut.score == 1000 * (big - 1) * (big + 7) // ((big - 1) * (big + 3))
