from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cases import WORD, clashing, frame, hard_texts, prose
from weirstone.llm import mixing


def filled(sizes):
    """Targets by reference to the rule: share, cut at three times, share again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        for s in order:
            target[s] = 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free)
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sources", [("a", "b", None), ("a",), ("é", "Z", "a", "", None)])
def test_targets_and_taken(spark, sources):
    texts = [*hard_texts(), *(prose(k, 20 + k * 3) for k in range(120))]
    df = frame(spark, texts, sources)
    size = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts, 1)}
    source = {i: sources[(i - 1) % len(sources)] for i in size}
    sums = defaultdict(int)
    for i in size:
        sums[source[i]] += size[i]
    target = filled(sums)
    rows = mixing.allot(clashing(df)).collect()
    assert {r.id: r["size"] for r in rows} == size
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sums[source[r.id]] and r.target == pytest.approx(target[source[r.id]])
        assert 0 <= r.copies <= 3
        taken[source[r.id]] += r.copies * r["size"]
    for s in sums:
        assert abs(taken[s] - target[s]) <= 2 * max(size[i] for i in size if source[i] == s)
    assert {(r.id, r.copies) for r in mixing.allot(df).collect()} == {(r.id, r.copies) for r in rows}
    mixed = mixing.mix(clashing(df))
    assert mixed.columns == clashing(df).columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.id: r.copies for r in rows if r.copies})


def test_edges(spark):
    assert mixing.allot(frame(spark, [])).count() == 0 == mixing.mix(frame(spark, [])).count()
    assert [r.copies for r in mixing.allot(frame(spark, [None, ""])).collect()] == [0, 0]
    df = frame(spark, [prose(1, 30)] * 3, ("a",))
    assert mixing.mix(df.union(df)).count() == 6


def test_rows_that_share_an_id(spark):
    rows = [(k % 7, prose(k % 3, 20 + k % 4), "en", ["a", "b", None][k % 2 if k < 90 else 2], k) for k in range(120)]
    rows += [(None, None, "en", "b", 0), (None, prose(1, 20), None, None, 1), (None, prose(1, 20), None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    key = lambda r: (r["doc_id"], r["source"], len(WORD.findall(r["text"] or "")))
    copies = Counter()
    # the source is the first to be ordered by, so an id that holds it as well is in the same order
    for r in mixing.allot(df.withColumn("doc_id", F.struct("doc_id", "source"))).collect():
        copies[(r.id.doc_id, r.id.source, r["size"])] += r.copies
    mixed = mixing.mix(df).collect()
    assert Counter(map(key, mixed)) == Counter({k: n for k, n in copies.items() if n})
    assert max(Counter(tuple(r) for r in mixed).values()) <= 3 * max(Counter(rows).values())


def test_whole_rows_are_not_stored(spark, monkeypatch):
    """Their sorted copy was on disk along with the shuffle that made it."""
    from weirstone.operators import ordering

    written = {}
    keep, keep_sorted = mixing.stored, ordering.materialise
    monkeypatch.setattr(mixing, "stored", lambda df, label: written.setdefault(label, keep(df, label)))
    monkeypatch.setattr(ordering, "materialise", lambda df, label: written.setdefault(label, keep_sorted(df, label)))
    df = clashing(frame(spark, [prose(k, 300) for k in range(40)]))
    mixed = mixing.mix(df)
    # of whole rows, of their places, and of the counts of ranges
    assert mixed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 3
    assert mixed.count() > 0 and {"sizes", "targets", "rank"} <= set(written)
    for stored in written.values():
        longest = [f.name for f in stored.schema if f.dataType.typeName() in ("struct", "string")]
        assert set(longest) <= {"_source"}
