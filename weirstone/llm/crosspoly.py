"""Near duplicates among embeddings by cross-polytope hashing with multiprobe buckets.

A hash turns a vector by three rounds of random signs and a fast Hadamard
transform and takes the coordinate that is largest in absolute value, with its
sign.  A table joins ``HASHES`` of them; a vector is kept in its own bucket and
probes those where one or each hash takes its second choice.  Two vectors meet
in a table where the own bucket of one is among the buckets of the other.
Candidates are verified by their cosine in double precision, so no link is
below the threshold; recall follows from the number of tables.

Equal vectors are one class from the start.  A bucket is compared in blocks of
``BLOCK`` rows, each pair of blocks in one task, so a bucket of any size spreads
over the cluster.  A pair that meets in several buckets counts in the first one
only, which both sides can tell from their bucket numbers; so links are counted
where they are found, and only counts and the local components leave a task,
never the pairs of a group.

Defined results: a vector that is null, empty or zero, or that holds null or
non-finite values, and a row without id, link with nothing; so do vectors of
different lengths; rows that repeat are linked as copies are; an empty table
gives no rows; other columns, labels too, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import ship, stored
from weirstone.llm.links import components

COSINE = 0.9
TABLES, HASHES, SEED = 8, 2, 11
# The choices, first or second, that the hashes of a table take in each probe; the first is the own bucket.
PROBES = ((0, 0), (1, 0), (0, 1), (1, 1))
BLOCK = 1024
SMALL = 32  # groups up to this size are compared pair by pair, larger ones by a matrix product
_MEET = np.zeros((len(PROBES), len(PROBES)), bool)
_MEET[0, :] = _MEET[:, 0] = True


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


@lru_cache
def signs(dim: int) -> np.ndarray:
    """Random signs by table, hash and round."""
    return np.random.default_rng([SEED, dim]).choice([-1.0, 1.0], (TABLES, HASHES, 3, dim))


def buckets(x: np.ndarray) -> np.ndarray:
    """Bucket numbers of unit vectors (rows): vector, table, probe."""
    dim = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), dim))
    padded[:, : x.shape[1]] = x
    flips = signs(dim)
    out = np.zeros((len(x), TABLES, len(PROBES)), np.int64)
    line = np.arange(len(x))
    for t in range(TABLES):
        for h in range(HASHES):
            y = padded
            for r in range(3):
                y = hadamard(y * flips[t, h, r])
            best = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            size = np.abs(y[line[:, None], best])
            best = np.where((size[:, :1] >= size[:, 1:]), best, best[:, ::-1])
            code = 2 * best + (y[line[:, None], best] < 0)
            for p, choice in enumerate(PROBES):
                out[:, t, p] = out[:, t, p] * (2 * dim) + code[:, choice[h]]
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    """The vectors as rows, each scaled by a power of two so that no product overflows; cosines stay the same."""
    rows = np.stack([np.frombuffer(v, np.float64) for v in column.to_pylist()])
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


CELL = "table int, bucket bigint, dim int, cid bigint"


def _placed(classes: DataFrame, whole: bool) -> DataFrame:
    """A row per class and bucket; ``whole`` adds what is needed to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                for at in range(0, own.num_rows, 1000):
                    part = own.slice(at, 1000)
                    codes = buckets(_unit(_vectors(part.column("v"))))
                    n, rows = part.num_rows, TABLES * len(PROBES)
                    line = np.repeat(np.arange(n), rows)
                    columns = [
                        pa.array(np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), len(PROBES)), n)),
                        pa.array(codes.reshape(-1)),
                        pa.array(np.full(n * rows, dim, np.int32)),
                        part.column("cid").take(pa.array(line)),
                    ]
                    if whole:
                        packed = pa.array([c.tobytes() for c in codes], pa.binary())
                        columns += [
                            pa.array(np.tile(np.arange(rows) % len(PROBES) == 0, n)),
                            *(x.take(pa.array(line)) for x in (part.column("m"), packed, part.column("v"))),
                        ]
                    names = ["table", "bucket", "dim", "cid", *(["own", "m", "codes", "v"] if whole else [])]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = CELL + (", own boolean, m bigint, codes binary, v binary" if whole else "")
    return classes.mapInArrow(run, kinds)


def _candidates(group: np.ndarray, side: np.ndarray, starts: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs inside groups (rows in order of group) that may reach the threshold."""
    sizes = np.diff(np.append(starts, len(group)))
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, int(sizes.max()))):
        a = np.flatnonzero((group[step:] == group[:-step]) & small[:-step])
        left.append(a)
        right.append(a + step)
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        x = unit[start : start + size]
        a, b = np.nonzero(np.triu(x @ x.T >= COSINE - 1e-6, 1))
        left.append(a + start)
        right.append(b + start)
    a, b = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (left, right))
    # of two blocks only pairs across count; in one block the side is 2
    keep = (side[a] != side[b]) | (side[a] == 2)
    return a[keep], b[keep]


def _roots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each component of links between nodes 0, 1, ...; both ends are given."""
    label = np.arange(max(a.max(), b.max()) + 1)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compared(rows: DataFrame) -> DataFrame:
    """Links found in sorted cells: class ``cid``, ``links`` to others, and ``root`` of its component here."""
    key = ["table", "bucket", "dim", "i", "j"]

    def found(part: pa.Table) -> pa.RecordBatch | None:
        ids = np.stack([part.column(k).to_numpy().astype(np.int64) for k in key])
        new = np.append(True, (ids[:, 1:] != ids[:, :-1]).any(axis=0))
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        many = np.diff(np.append(starts, len(group)))[group] > 1
        if not many.any():
            return None
        part, group, ids = part.filter(pa.array(many)), group[many], ids[:, many]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        out = []
        for dim in np.unique(ids[2]):
            at = np.flatnonzero(ids[2] == dim)
            own = part.take(pa.array(at))
            v = _vectors(own.column("v"))
            g = group[at]
            a, b = _candidates(g, own.column("side").to_numpy(), np.flatnonzero(np.append(True, g[1:] != g[:-1])), _unit(v))
            primary = own.column("own").to_numpy(zero_copy_only=False)
            keep = primary[a] | primary[b]
            a, b = a[keep], b[keep]
            cid, m = own.column("cid").to_numpy(), own.column("m").to_numpy()
            codes = np.stack([np.frombuffer(c, np.int64).reshape(TABLES, len(PROBES)) for c in own.column("codes").to_pylist()])
            here, bucket = ids[0][at], ids[1][at]
            for k in range(0, len(a), 20_000):
                x, y = a[k : k + 20_000], b[k : k + 20_000]
                cosine = (v[x] * v[y]).sum(axis=1) / (np.linalg.norm(v[x], axis=1) * np.linalg.norm(v[y], axis=1))
                x, y = x[(cosine >= COSINE) & (cid[x] != cid[y])], y[(cosine >= COSINE) & (cid[x] != cid[y])]
                meet = (codes[x][:, :, :, None] == codes[y][:, :, None, :]) & _MEET
                table = meet.any(axis=(2, 3)).argmax(axis=1)
                line = np.arange(len(x))
                met = np.where(meet[line, table], codes[x][line, table][:, :, None], np.iinfo(np.int64).max)
                first = (table == here[x]) & (met.min(axis=(1, 2)) == bucket[x])
                out.append((cid[x[first]], cid[y[first]], m[x[first]], m[y[first]]))
        out = [x for x in out if len(x[0])]
        if not out:
            return None
        a, b, am, bm = (np.concatenate(z) for z in zip(*out, strict=True))
        nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        links = np.bincount(where, weights=np.concatenate([bm, am])).astype(np.int64)
        root = nodes[_roots(where[: len(a)], where[len(a) :])]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(root)], names=["cid", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([*(held.to_batches() if held else []), batch]).combine_chunks()
            last = [part.column(k)[-1].as_py() for k in key]
            same = np.logical_and.reduce([part.column(k).to_numpy() == x for k, x in zip(key, last, strict=True)])
            cut = int(len(same) - same.sum())  # the last group may go on
            held = part.slice(cut)
            if cut and (out := found(part.slice(0, cut))) is not None:
                yield out
        if held is not None and (out := found(held)) is not None:
            yield out

    return rows.mapInArrow(run, "cid bigint, links bigint, root bigint")


def link(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id``, ``n_links``, ``component_id`` of every row of ``vectors``."""
    ship(vectors.sparkSession)
    values = F.col(vector_col).cast("array<double>")
    finite = F.forall(values, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    usable = F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False)) & F.col(id_col).isNotNull()
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.when(usable, values).alias("values"),
        F.when(usable, F.xxhash64(F.lit(1), values)).alias("k"),
        F.when(usable, F.xxhash64(F.lit(2), values)).alias("l"),
    )
    grouped = rows.where("values IS NOT NULL").groupBy("k", "l")
    classes = grouped.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m"), F.first("values").alias("values"))
    packed = stored(_packed(classes.withColumn("cid", F.monotonically_increasing_id())), "vectors")
    crowded = _placed(packed, False).groupBy("table", "bucket", "dim").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = stored(crowded.select("table", "bucket", "dim", F.ceil(F.col("n") / BLOCK).alias("blocks")), "buckets")
    full = _placed(packed, True).join(blocks, ["table", "bucket", "dim"])
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    cells = full.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = cells.select(
        *("table", "bucket", "dim", "cid", "own", "m", "codes", "v"),
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    key = ["table", "bucket", "dim", "i", "j"]
    found = stored(_compared(placed.repartition(*key).sortWithinPartitions(*key)), "links")
    roots = components(found.where("cid <> root").select("cid", "root"))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = packed.select("k", "l", "first", "m", "cid").join(counts, "cid", "left")
    named = named.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_vector = named.join(least, "root").select("k", "l", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), "component_id")
    return rows.join(by_vector, ["k", "l"], "left").select(
        "id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )


def _packed(classes: DataFrame) -> DataFrame:
    """The classes with their vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array(v, np.float64) for v in batch.column("values").to_pylist()]
            columns = [batch.column(n) for n in ("k", "l", "first", "m", "cid")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(v) for v in values], pa.int32()), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["k", "l", "first", "m", "cid", "dim", "v"],
            )

    return classes.mapInArrow(run, "k bigint, l bigint, first bigint, m bigint, cid bigint, dim int, v binary")
