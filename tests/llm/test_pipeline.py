"""The pipeline against brute force, stage by stage: each is judged on what it got."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as public

import corpus_pipeline
from cases import clashing, frame, hard_texts, prose
from test_jaccard import brute as groups
from test_jaccard import edited
from test_quality_rules import brute as rules
from weirstone.llm import bpe


def corpus():
    out = [*hard_texts(), *(prose(k, 80 + k) for k in range(40))]
    out += [edited(out[20], 1 + k % 3, k) for k in range(6)] + [out[25]] * 15 + [out[26]] * 3
    out += [f"{prose(700 + k, 70)}\nThis page was printed by reader {k}" for k in range(14)]
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = frame(spark, corpus())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    # all but the symbol-ridden text are trusted, so only that one stands out
    trusted = set(range(1, docs.count() + 1)) - {11}
    labels = spark.createDataFrame([(i, int(i in trusted), 0) for i in [*trusted, 11]], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_templates", "jaccard_join", "source_mixing", "byte_bpe"]
    columns = docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    good = steps["quality_rules"](spark, docs, sf).cache()
    assert good.columns == columns
    assert sorted(i for i, _ in rows(good)) == [r[0] for r in rules(rows(docs), trusted) if r[-1]]
    assert 11 not in dict(rows(good))

    lined = steps["line_templates"](spark, good, sf).cache()
    assert lined.columns == columns and lined.dtypes == docs.dtypes
    before, after = dict(rows(good)), dict(rows(lined))
    assert set(after) <= set(before)
    printed = [i for i, t in after.items() if "This page was printed" in t]
    assert len(printed) == 1
    copies = [i for i, t in before.items() if t == corpus()[25]]
    assert [i for i in copies if i in after] == [min(copies)]
    assert all(r.n_chars == len(r.text) for r in lined.collect() if r.text != before[r.doc_id])

    single = steps["jaccard_join"](spark, lined, sf).cache()
    assert single.columns == columns
    assert sorted(i for i, _ in rows(single)) == sorted({c for _, _, c in groups(rows(lined))})

    mixed = steps["source_mixing"](spark, single, sf).cache()
    assert mixed.columns == columns
    assert set(rows(mixed)) <= set(rows(single)) and max(Counter(rows(mixed)).values()) <= 3

    enc = bpe.encoder(bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
    coded = steps["byte_bpe"](spark, mixed, sf).collect()
    expected = Counter((i, tuple(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows(mixed))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded_sha256) for r in coded) == expected

    whole = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in whole) == Counter((r.doc_id, bytes(r.ids)) for r in coded)


def _tables(spark, docs, path, labels=()):
    docs.write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_empty_tables(spark, tmp_path):
    sf = _tables(spark, frame(spark, corpus()).limit(0), tmp_path)
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_repeated_ids_and_clashing_columns(spark, tmp_path):
    # without a trusted text every ratio is 0, and only the base rules reject
    texts = [prose(800 + k, 90) for k in range(12)] + [None, "", "few words"]
    docs = clashing(frame(spark, texts))
    twice = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.where("doc_id = 2").withColumn("text", docs.lang))
    sf = _tables(spark, twice, tmp_path)
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["quality_rules"](spark, twice, sf)
    assert kept.columns == twice.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, *range(2, 13)]
    single = steps["jaccard_join"](spark, steps["line_templates"](spark, kept, sf), sf)
    assert single.columns == twice.columns and {r.doc_id for r in single.collect()} == set(range(1, 13))
    assert corpus_pipeline.run(spark, sf).where("n_tokens > 0").count() > 0


def test_near_copies_reach_the_near_duplicate_stage(spark, tmp_path):
    base = [prose(900 + k, 300) for k in range(8)]
    near = [edited(t, 6, k) for k, t in enumerate(base)]  # most lines equal, some edited
    passage = prose(950, 24, line=24)
    shared = [f"{prose(960 + k, 200)}\n{passage}" for k in range(4)]
    docs = frame(spark, base + near + shared)
    sf = _tables(spark, docs, tmp_path)
    steps = dict(corpus_pipeline.STAGES)
    lined = steps["line_templates"](spark, docs, sf)
    after = {r.doc_id: r.text for r in lined.collect()}
    assert [i for i in range(17, 21) if passage in after[i]] == [17]  # a shared passage stays in its first text
    assert {r.doc_id for r in steps["jaccard_join"](spark, lined, sf).collect()} == {*range(1, 9), *range(17, 21)}
