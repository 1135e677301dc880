import math
import random

import numpy as np

from cases import clashing
from weirstone.llm import hnsw
from weirstone.llm.queries import QUERIES

COLUMNS = "vec_id bigint, embedding array<float>, label int"


def fits(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, count=10):
    best = {}
    for i, v, _ in rows:
        if i is not None and fits(v):
            v = np.array(v, np.float32).astype(float).tolist()
            best[i] = min(best.get(i, v), v)
    out = {}
    for q, v in best.items():
        if q % 100 == 0:
            near = [(math.dist(v, w), i) for i, w in best.items() if i != q and len(w) == len(v)]
            out[q] = sorted(near)[:count]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def recall(expected, got):
    hits = sum(len({i for _, i in expected[q]} & {i for _, i in got.get(q, [])}) for q in expected)
    return hits / max(1, sum(map(len, expected.values())))


def table(spark, rows, path):
    clashing(spark.createDataFrame(rows, COLUMNS)).write.parquet(str(path / "embeddings.parquet"))
    return str(path)


def test_graph_recall():
    points = np.random.default_rng(4).normal(size=(3000, 24))
    tops = hnsw.tops_of(np.arange(3000))
    order = np.lexsort((np.arange(3000), -tops))
    graph = hnsw.Graph.build(points[order], tops[order])
    assert graph.sizes[0] == 3000 and graph.sizes == sorted(graph.sizes, reverse=True)
    near, gaps = graph.nearest(points[:700])
    assert (np.diff(gaps, axis=1) >= 0).all()
    hits = 0
    for q in range(700):
        away = np.sqrt(((points[order] - points[q]) ** 2).sum(axis=1))
        hits += len(set(np.argsort(away)[:10].tolist()) & set(near[q][:10].tolist()))
    assert hits / 7000 >= 0.95


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 700)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], 1) for i in range(2500)]
    common = [0.5] * 16
    rows += [(3000 + i, common, 2) for i in range(400)]
    rows += [(100, rows[100][1], 1), (3000, common, 5)]  # repeated rows
    got = found(QUERIES["op12_hnsw"](spark, table(spark, rows, tmp_path)))
    expected = brute(rows)
    assert got.keys() == expected.keys()
    assert recall(expected, got) >= 0.95
    for q in range(3000, 3400, 100):  # of a group of copies the smallest ids, never the query
        assert [i for _, i in got[q]] == [i for i in range(3000, 3012) if i != q][:10]
    for q, near in got.items():
        exact = dict((i, s) for s, i in brute(rows, len(rows))[q]) if q in (0, 700) else None
        assert len(near) == 10 and near == sorted(near)
        if exact:
            assert all(abs(exact[i] - s) <= 1e-12 * (1 + s) for s, i in near)


def test_hard_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [], 0), (8, [1.0, None], 0), (9, [1.0, 2.0, 3.0], 0), (100, [1.0, 2.0, 4.0], 0),
        (200, [0.0, 0.0], 0), (None, [1.0, 1.0], 0), (300, [5.0], 0), (2, [0.0, 0.5], 0), (400, [3e38, 3e38], 0),
    ]
    got = found(QUERIES["op12_hnsw"](spark, table(spark, rows, tmp_path)))
    expected = {q: n for q, n in brute(rows).items() if n}
    assert {q: [i for _, i in n] for q, n in got.items()} == {q: [i for _, i in n] for q, n in expected.items()}
    assert all(math.isclose(a[0], b[0], rel_tol=1e-12) for q in got for a, b in zip(got[q], expected[q]))


def test_empty_table(spark, tmp_path):
    assert QUERIES["op12_hnsw"](spark, table(spark, [], tmp_path)).count() == 0


def test_recall_on_the_test_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert recall(brute(rows), found(QUERIES["op12_hnsw"](spark, sf))) >= 0.95
