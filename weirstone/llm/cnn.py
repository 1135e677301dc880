"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by one
filter width, so every window of the filters lies whole in some chunk and the
chunks cover the whole text.  In each chunk, embedded bytes pass through
learned filters, and each filter keeps its maximum.  The text's features are the
maximum, the mean and the minimum of these over its chunks; a small dense layer
turns them into one probability.

Training runs in one task over a bounded sample: the ``MAX_TRAIN`` labelled
documents with the smallest hashes of their id among those that may be learned
from.  It is seeded, so reruns give the same weights on the same machine type.
Scoring is one pass over all texts with no shuffle.

Defined results: a null or empty text is one chunk of padding and gets the
score that follows; without labelled rows of both kinds every score is 0.5;
rows that repeat are scored each; an empty table gives no rows; labels that are
null or neither 0 nor 1 are not learned from; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import bytes_of, ship, slices, stored

CHUNK, WIDTH, STRIDE = 512, 8, 4
EMBED, FILTERS, HIDDEN = 8, 32, 16
MAX_TRAIN = 3000
EPOCHS, BATCH, RATE, SEED = 6, 24, 0.004, 7
# Chunks that one matrix product works on.
BLOCK = 256


def chunks(data: bytes) -> np.ndarray:
    """The chunks of a text as rows of bytes; the last is padded with zeros."""
    step = CHUNK - WIDTH
    count = max(1, -(-max(len(data) - WIDTH, 0) // step))
    padded = np.zeros((count - 1) * step + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def start(rng: np.random.Generator) -> dict:
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return {
        "embed": normal(256, EMBED, scale=0.5),
        "conv": normal(WIDTH * EMBED, FILTERS, scale=(2 / (WIDTH * EMBED)) ** 0.5),
        "conv_bias": np.zeros(FILTERS, np.float32),
        "dense": normal(3 * FILTERS, HIDDEN, scale=(2 / (3 * FILTERS)) ** 0.5),
        "dense_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, 1, scale=HIDDEN**-0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def windows(rows: np.ndarray, embed: np.ndarray) -> np.ndarray:
    """Embedded windows of all chunks: chunk, position, value."""
    values = embed[rows].reshape(len(rows), CHUNK * EMBED)
    return np.lib.stride_tricks.sliding_window_view(values, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]


def pooled(rows: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Maximum of each filter in each chunk, and its position."""
    best, where = [], []
    for i in range(0, len(rows), BLOCK):
        seen = windows(rows[i : i + BLOCK], p["embed"])
        n, m, k = seen.shape
        out = (np.ascontiguousarray(seen).reshape(n * m, k) @ p["conv"]).reshape(n, m, FILTERS)
        at = out.argmax(axis=1)
        where.append(at)
        best.append(np.take_along_axis(out, at[:, None], axis=1)[:, 0])
    return np.concatenate(best) + p["conv_bias"], np.concatenate(where)


def combine(best: np.ndarray, starts: np.ndarray, p: dict) -> tuple[np.ndarray, ...]:
    """Features and probability of each text from its chunks; ``starts`` are the first chunks."""
    act = np.maximum(best, 0)
    counts = np.diff(np.append(starts, len(best)))[:, None]
    features = np.concatenate(
        [
            np.maximum.reduceat(act, starts),
            np.add.reduceat(act, starts) / counts,
            np.minimum.reduceat(act, starts),
        ],
        axis=1,
    )
    hidden = np.maximum(features @ p["dense"] + p["dense_bias"], 0)
    logit = (hidden @ p["out"] + p["out_bias"])[:, 0]
    return act, features, hidden, 1 / (1 + np.exp(-np.clip(logit, -30, 30).astype(np.float64)))


def probabilities(texts: list[bytes], p: dict) -> np.ndarray:
    parts = [chunks(t) for t in texts]
    starts = np.cumsum([0, *(len(c) for c in parts[:-1])])
    return combine(pooled(np.concatenate(parts), p)[0], starts, p)[3]


def gradients(parts: list[np.ndarray], y: np.ndarray, w: np.ndarray, p: dict) -> dict:
    """Of the weighted log loss of a batch of texts, given as chunks."""
    rows = np.concatenate(parts)
    starts = np.cumsum([0, *(len(c) for c in parts[:-1])])
    owner = np.repeat(np.arange(len(parts)), [len(c) for c in parts])
    best, where = pooled(rows, p)
    act, features, hidden, prob = combine(best, starts, p)
    g_logit = ((prob - y) * w / len(parts)).astype(np.float32)[:, None]
    g = {"out": hidden.T @ g_logit, "out_bias": g_logit.sum(0)}
    g_hidden = (g_logit @ p["out"].T) * (hidden > 0)
    g |= {"dense": features.T @ g_hidden, "dense_bias": g_hidden.sum(0)}
    g_top, g_mean, g_low = np.split(g_hidden @ p["dense"].T, 3, axis=1)
    top, _, low = np.split(features, 3, axis=1)
    counts = np.array([len(c) for c in parts], np.float32)[:, None]
    g_act = (act == top[owner]) * g_top[owner] + (g_mean / counts)[owner] + (act == low[owner]) * g_low[owner]
    g_best = g_act * (best > 0)
    seen = windows(rows, p["embed"])
    g_conv = np.zeros_like(p["conv"])
    g_embed = np.zeros_like(p["embed"])
    line = np.arange(len(rows))
    for f in range(FILTERS):
        g_f = g_best[:, f]
        g_conv[:, f] = seen[line, where[:, f]].T @ g_f
        places = where[:, f, None] * STRIDE + np.arange(WIDTH)
        back = g_f[:, None, None] * p["conv"][:, f].reshape(WIDTH, EMBED)
        np.add.at(g_embed, np.take_along_axis(rows, places, axis=1).ravel(), back.reshape(-1, EMBED))
    return g | {"conv": g_conv, "conv_bias": g_best.sum(0), "embed": g_embed}


def train(texts: list[bytes], labels: np.ndarray) -> dict | None:
    """Weights fitted with Adam, classes weighted alike up to a third; None without both labels."""
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(SEED)
    p = start(rng)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    share = y.mean()
    w = np.where(y == 1, 1.0, min(3.0, share / (1 - share)))
    parts = [chunks(t) for t in texts]
    steps = 0
    total = EPOCHS * -(-len(y) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            at = order[i : i + BATCH]
            g = gradients([parts[j] for j in at], y[at], w[at], p)
            steps += 1
            rate = RATE * (1 - 0.9 * steps / total)
            for k in p:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] ** 2 - second[k])
                move = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
                p[k] -= (rate * move).astype(np.float32)
    return p


def fit(
    docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> bytes:
    """Weights learned from labelled rows for which ``may_learn`` (over the labels' columns) holds."""
    ship(docs.sparkSession)
    known = labels.where(may_learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_label"))
    sample = marked.orderBy(F.xxhash64("_id"), "_id").limit(MAX_TRAIN)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        texts, y = [], []
        for batch in batches:
            texts += bytes_of(batch, "_text")
            y += batch.column("_label").to_pylist()
        order = sorted(range(len(y)), key=lambda i: (texts[i], y[i]))  # whatever order the rows came in
        weights = train([texts[i] for i in order], np.array([y[i] for i in order]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(weights)], pa.binary())], names=["weights"])

    # all tasks look for the sample; one task then reads the sample alone
    chosen = stored(rows.join(F.broadcast(sample), "_id").select("_text", "_label"), "sample")
    model = stored(chosen.coalesce(1).mapInArrow(run, "weights binary"), "cnn")
    found = model.first()
    return pickle.dumps(None) if found is None else bytes(found[0])


def score(docs: DataFrame, weights: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every whole text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        p = pickle.loads(shared.value)
        for part in slices(batches, "_text", 1 << 20):
            if p is None:
                values = np.full(part.num_rows, 0.5)
            else:
                values = probabilities(bytes_of(part, "_text"), p)
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(values, pa.float64())], names=[id_col, "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double")
