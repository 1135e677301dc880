import random

import numpy as np
import pytest

from cases import clashing, frame, hard_texts, prose
from weirstone.llm import suffixes


def brute(rows):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for p in range(len(b) - 49):
                k = b[p : p + 50]
                first[k] = min(first.get(k, i), i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - 49):
                if first[b[p : p + 50]] < i:
                    gone[p : p + 50] = b"\1" * 50
        spans = bytes(gone).replace(b"\0", b" ").split()
        out.append((i, len(b), sum(gone), len(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def run(df):
    rows = suffixes.remove_repeats(df).select("id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted((tuple(r[:4]) + (bytes(r[4]),) for r in rows), key=str)


def many():
    rng = random.Random(3)
    out = hard_texts()
    shared = [prose(900 + k, 15) for k in range(5)]
    for k in range(60):
        parts = [prose(1000 + k, 8), rng.choice(shared), prose(2000 + k, 5), rng.choice(shared)[rng.randrange(20) :]]
        out.append(" ".join(parts))
    out += ["ab" * 300, "a" * 500, "ba" * 200, "a" * 51, "abc" * 100, "a" * 49]
    out += [prose(7, 30)[:n] for n in (49, 50, 51, 52, 90)]
    rng.shuffle(out)
    return out


def test_against_brute_force(spark):
    texts = many()
    assert run(frame(spark, texts)) == brute(list(enumerate(texts, 1)))


@pytest.mark.parametrize("piece", [64, 300])
def test_pieces(spark, monkeypatch, piece):
    groups = [g for g in (suffixes._cut([b"", b"x" * 49, bytes(range(200)), b"y" * 50]))]
    starts = sorted((i, o + p) for g in groups for i, o, b in g for p in range(len(b) - 49))
    assert starts == [(2, p) for p in range(151)] + [(3, 0)]
    monkeypatch.setattr(suffixes, "PIECE", piece)
    groups = [g for g in suffixes._cut([bytes(range(200)), b"y" * 1000])]
    starts = sorted((i, o + p) for g in groups for i, o, b in g for p in range(len(b) - 49))
    assert starts == [(0, p) for p in range(151)] + [(1, p) for p in range(951)]


def test_only_what_is_left_is_looked_at_again():
    """The first of a task counted as shared even where all others were found, and every such start was compared alone."""
    key, same = np.array([9, 5, 9, 7, 5, 5], np.uint64), np.array([1, 1, 1, 1, 2, 1], np.uint64)
    doc, packed = np.array([4, 1, 3, 1, 2, 2]), np.arange(6) << 2
    out, known = suffixes._folded(key, doc, packed, same)
    assert known.tolist() == [suffixes.FOUND, suffixes.SHARED, 0, 0, suffixes.SHARED, suffixes.FOUND]
    assert [int(k) for k in out[[1, 2, 3]]] == [5, 9, 7] and len(set(out.tolist())) == 6
    assert [len(x) for x in suffixes._folded(key[:0], doc[:0], packed[:0], same[:0])] == [0, 0]


def test_names_do_not_depend_on_blocks():
    data = np.random.default_rng(4).integers(0, 4, 2 * suffixes.BLOCK + 40).astype(np.uint8)
    gram, half = suffixes.names(data)
    for size in (0, 19, 20, 31, 32, suffixes.BLOCK + 19, suffixes.BLOCK + 31, suffixes.BLOCK + 32):
        ends = suffixes.names(data[len(data) - size :])
        assert [len(e) for e in ends] == [max(0, size - 19), max(0, size - 31)]
        assert all((e == whole[len(whole) - len(e) :]).all() for e, whole in zip(ends, (gram, half), strict=True))


def test_repeated_and_null_ids(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(5, a + " one"), (5, b + " two"), (5, a + " one"), (7, a), (None, b), (9, b), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(clashing(df)) == brute(rows)
    assert run(df.where("doc_id > 100")) == []


def test_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_texts_under_one_id_are_counted(spark):
    df = spark.createDataFrame([(1, t) for t in ("a", "b", "c", "c", None)] + [(None, "d"), (None, "e"), (2, "f")], "doc_id bigint, text string")
    rows = suffixes._numbered(df, "doc_id", "text", 4).collect()
    assert sorted(r._variant for r in rows if r._id == 1) in ([0, 1, 2, 3, 3], [0, 1, 2, 2, 3], [0, 1, 1, 2, 3], [0, 0, 1, 2, 3])
    assert all(r._variant == 0 for r in rows if r._id != 1)
    with pytest.raises(Exception, match="too many different texts under id 1"):
        suffixes._numbered(df, "doc_id", "text", 3)
