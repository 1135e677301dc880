import zlib

import numpy as np

from cases import clashing, frame, hard_texts, prose
from weirstone.llm import cnn
from weirstone.llm.queries import QUERIES


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, 9, 504, 511, 512, 513, 1016, 1017, 5000):
        data = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        rows = cnn.chunks(data)
        seen = {bytes(r[k : k + cnn.WIDTH]) for r in rows for k in range(cnn.CHUNK - cnn.WIDTH + 1)}
        assert all(data[k : k + cnn.WIDTH] in seen for k in range(max(0, n - cnn.WIDTH + 1)))
        assert rows.shape[1] == cnn.CHUNK


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in cnn.start(rng).items()}
    parts = [cnn.chunks(t.encode()) for t in (prose(1, 200), "AB!! " * 60, "")]
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss(q):
        starts = np.cumsum([0, *(len(c) for c in parts[:-1])])
        prob = cnn.combine(cnn.pooled(np.concatenate(parts), q)[0], starts, q)[3]
        return -np.mean(y * np.log(prob) + (1 - y) * np.log(1 - prob))

    g = cnn.gradients(parts, y, w, p)
    for name in ("out", "dense", "conv", "conv_bias", "embed"):
        flat = np.argsort(-np.abs(g[name]).ravel())[:3]
        for at in flat:
            q = {k: v.copy() for k, v in p.items()}
            q[name].ravel()[at] += 1e-5
            up = loss(q)
            q[name].ravel()[at] -= 2e-5
            assert abs((up - loss(q)) / 2e-5 - g[name].ravel()[at]) < 1e-3 * max(1, abs(g[name].ravel()[at]))


def test_scores_of_hard_rows(spark):
    p = cnn.start(np.random.default_rng(1))
    import pickle

    texts = hard_texts()
    out = cnn.score(clashing(frame(spark, texts)), pickle.dumps(p)).collect()
    one = {i: cnn.probabilities([(t or "").encode()], p)[0] for i, t in enumerate(texts, 1)}
    assert {r.doc_id for r in out} == set(one)
    assert all(abs(r.score - one[r.doc_id]) < 1e-5 for r in out)
    assert cnn.score(frame(spark, []), pickle.dumps(p)).count() == 0


def test_without_labels(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, hard_texts())
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id bigint, quality int")
    weights = cnn.fit(docs, labels, F.lit(True))
    assert {r.score for r in cnn.score(docs, weights).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op6_byte_cnn"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert len(held) > 500 and np.mean([a == b for a, b in held]) >= 0.95
