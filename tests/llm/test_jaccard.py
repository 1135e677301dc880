import random

import numpy as np

from cases import WORD, clashing, frame, hard_texts, prose
from weirstone.llm import jaccard
from weirstone.llm.links import components


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def brute(rows):
    sets = {}
    for i, t in rows:
        sets[i] = shingle_set(t)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                i = len(x & y)
                if 100 * i >= 80 * (len(x) + len(y) - i):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def run(df):
    return sorted(tuple(r) for r in jaccard.near_duplicates(df).select("id", "n_shingles", "component_id").collect())


def edited(text, edits, seed):
    rng = random.Random(seed)
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def many():
    """Groups around a text that is there or not, chains of edits, shared passages, short texts."""
    out = hard_texts()
    base = prose(50, 300)
    out += [edited(base, k % 9, k) for k in range(40)]
    other = prose(51, 120)
    out += [edited(other, 2 + k % 4, 100 + k) for k in range(25)]
    chain = prose(52, 200)
    for k in range(12):
        chain = edited(chain, 3, 200 + k)
        out.append(chain)
    passage = prose(53, 60)
    out += [f"{prose(300 + k, 20)} {passage} {prose(400 + k, 20)}" for k in range(20)]
    out += ["a b c d e f", "a b c d e f", "A b c d e F", "a b c", "a b c d", "a b c"]
    random.Random(5).shuffle(out)
    return out


def test_against_brute_force(spark):
    texts = many()
    expected = brute(list(enumerate(texts, 1)))
    assert run(frame(spark, texts)) == expected
    assert len({c for _, _, c in expected}) < len(texts) - 40


def test_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert run(df) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_edges_of_input(spark):
    assert run(frame(spark, [])) == []
    df = frame(spark, ["a b c d e f g", "a b c d e f g", None])
    twice = df.union(df).union(spark.sql("SELECT NULL, 'a b c d e f g', 'en', 'a', 1L"))
    assert sorted(map(str, run(clashing(twice)) if False else [tuple(r) for r in jaccard.near_duplicates(twice).collect()])) == sorted(
        map(str, [(1, 3, 1), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (3, 0, 3), (None, 3, None)])
    )


def test_stage_keeps_one(spark):
    df = clashing(frame(spark, many()))
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted({c for _, _, c in run(df)})


def test_shingle_hash_depends_on_order_and_length():
    assert len({jaccard.shingles(t.encode())[0] for t in ("a b", "b a", "a b c", "a", "ab")}) == 5
    assert np.array_equal(jaccard.shingles(b"A b\tc"), jaccard.shingles(b"a  b\nc"))


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    names = rng.sample(range(10**6), 400)
    edges = [(names[i], names[i + 1]) for i in range(0, 299)] + [(names[300], names[i]) for i in range(301, 400)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).select("node", "root").collect())
    expected = {n: min(names[:300]) for n in names[:300]} | {n: min(names[300:]) for n in names[300:]}
    assert found == expected
