import hashlib
import random
import zlib

import numpy as np
import pytest

from cases import WORD, clashing, frame, hard_texts
from weirstone.llm import periods
from weirstone.llm.queries import QUERIES


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def brute_runs(words):
    """All maximal stretches by period, the smallest period of each stretch."""
    n, out, longest = len(words), [], {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            i = j
            if length >= max(6, 4 * q) and not any(
                q % r == 0 and s <= start and start + length <= s + m for s, m, r in out
            ):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = WORD.findall(text or "")
    words = words if doc_id is None else planted(words, doc_id)
    runs = brute_runs(words)
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


def repeated(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < 160:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        words += unit * rng.randint(1, 7) + [rng.choice("abc") for _ in range(rng.randint(0, 3))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_a_sequence(seed):
    docs = [repeated(seed * 10 + k) for k in range(4)] + [["x"] * 6, ["x"] * 5, [], ["y"] * 300]
    texts = [[w.encode() for w in d] for d in docs]
    words, starts, _ = periods._sequence(texts, [None] * len(texts))
    runs = periods.find_runs(words, max(map(len, texts)))
    expected = [(int(s) + a, n, q) for s, d in zip(starts, docs) for a, n, q in brute_runs(d)]
    assert sorted(map(tuple, runs.tolist())) == sorted(expected)


def test_wavelet_tree():
    values = np.random.default_rng(1).permutation(1000).astype(np.int32)
    tree = periods.WaveletTree(values)
    rng = random.Random(2)
    for _ in range(200):
        low = rng.randrange(999)
        high = rng.randrange(low + 1, 1001)
        at = int(values[rng.randrange(low, high)])
        inside = sorted(values[low:high].tolist())
        i = inside.index(at)
        after, before = tree.neighbours(np.array([low]), np.array([high]), np.array([at]))
        assert after[0] == (inside[i + 1] if i + 1 < len(inside) else -1)
        assert before[0] == (inside[i - 1] if i else -1)


def test_query_against_brute_force(spark, sf, tmp_path):
    rng = random.Random(5)
    texts = hard_texts()[:-2] + [" ".join(repeated(k)) for k in range(60)] + ["a b c a b c a b c a b", "a b c " * 4, "z " * 6]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(80)) for _ in range(150)] + ["a\x00b \x1f ä " * 9, "w " * 3000]
    df = clashing(frame(spark, texts)).unionByName(clashing(frame(spark, ["k l " * 9])))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op13_periods"](spark, str(tmp_path)).collect()
    expected = [brute(i, t) for i, t in [*enumerate(texts, 1), (1, "k l " * 9)]]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(1, len(texts) + 1)) > 5


def test_null_ids_and_empty_tables(spark):
    df = frame(spark, ["a b " * 8, None])
    nulls = df.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text")
    assert sorted((r.id, r.n_runs) for r in periods.text_runs(nulls).collect()) == [(None, 0), (None, 1)]
    assert periods.text_runs(df.limit(0)).count() == 0
