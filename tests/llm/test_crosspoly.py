import numpy as np
import pytest

from weirstone.llm import crosspoly

KIND = "vec_id bigint, embedding array<double>, label string, id string, cid string"


def brute(rows):
    good = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v) / np.abs(v).max()
    keys = sorted(good)
    root = {k: k for k in range(len(rows))}
    links = dict.fromkeys(range(len(rows)), 0)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, links[k], least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, "own", "own", "own") for i, v in rows], KIND)
    return sorted((tuple(r) for r in crosspoly.link(df).select("id", "n_links", "component_id").collect()), key=str)


def planted(rng, dim, groups, size, spread):
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        out += [centre + spread * rng.normal(size=dim) for _ in range(size)]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=64) for _ in range(300)]
    vectors += planted(rng, 64, 12, 5, 0.1) + planted(rng, 64, 1, 90, 0.12) + planted(rng, 7, 5, 4, 0.05)
    vectors += [vectors[0], vectors[0], 3 * vectors[0], vectors[1] * 1e200, np.ones(1), np.ones(1) * 2, -np.ones(1)]
    vectors = [v.tolist() for v in vectors]
    vectors += [None, [], [0.0] * 64, [1.0, None], [float("nan")] * 64, [float("inf"), 1.0]]
    order = rng.permutation(len(vectors))
    out = [(int(k), vectors[k]) for k in order]
    return out + [out[0], out[5], (None, vectors[0])]


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, rows, monkeypatch, block):
    monkeypatch.setattr(crosspoly, "BLOCK", block)
    found, expected = run(spark, rows), brute(rows)
    assert [r[0] for r in found] == [r[0] for r in expected]
    hit, all_ = sum(r[1] for r in found), sum(r[1] for r in expected)
    assert all(a[1] <= b[1] for a, b in zip(found, expected))  # nothing below the threshold
    assert hit >= 0.99 * all_ > 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a = crosspoly._unit(rng.normal(size=(2000, 64)))
    n = rng.normal(size=a.shape)
    n = crosspoly._unit(n - (n * a).sum(1, keepdims=True) * a)
    x, y = crosspoly.buckets(a), crosspoly.buckets(0.9 * a + np.sqrt(1 - 0.81) * n)
    assert ((x[:, :, :, None] == y[:, :, None, :]) & crosspoly._MEET).any(axis=(1, 2, 3)).mean() >= 0.95


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert sorted((tuple(r) for r in crosspoly.link(df).collect()), key=str) == brute(rows)
    assert run(spark, []) == []


def test_hadamard_is_orthogonal():
    x = np.eye(16)
    assert np.allclose(crosspoly.hadamard(x) @ crosspoly.hadamard(x).T, x)
