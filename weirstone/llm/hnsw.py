"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one class, so a graph holds no clump of copies; a class keeps
its smallest row ids, as many as an answer can need.  Classes are dealt to shards
by a hash, as many shards as classes fill.  A shard is built by one task and
stored as flat arrays: the vectors, the row ids of each class, and per layer the
places of every node's neighbours.

A node's top layer is drawn from a hash of its class (geometric, so each layer
has about a 16th of the one below).  Nodes are ordered by top layer, so a layer is
a prefix of the node order and its neighbour array needs no index.  Nodes enter
in blocks: each searches the graph so far, layer by layer from the top, and links
to a spread choice of the nearest it meets and of its own block (a candidate is
taken if it is nearer to the node than to all taken ones; free places then go to
the nearest left).  Links are made both ways, and a full list is chosen anew.

Queries come in blocks; every block is searched in every shard, and the nearest of
all shards are the answer.  All distances are in double precision on the vectors
as given.

Cases.  Vectors that are null, empty, zero or hold null or non-finite components
take no part.  Vectors of different lengths are not compared.  Rows with one id
and different vectors count with the smallest vector, as arrays compare; repeated
rows count once.  Ties go to the smaller id.  With fewer candidates than asked for
all come.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.llm.common import ship, stored

NEAREST = 10
# Classes of a shard, its components at most on average, and queries of a block.
SHARD, COMPONENTS, ASKED = 8192, 8 << 20, 4096
# Nodes that enter together, or queries searched together.
BLOCK = 512
# Links of a node in upper layers (twice as many in the lowest), and candidates held in a search.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 12, 40, 120
# Parts in which the smallest ids of one vector are looked for before the last choice.
_PARTS = 64


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the last axis; components of any size."""
    gap = a - b
    return np.sqrt(np.einsum("...d,...d->...", gap, gap))


class Graph:
    """Layers over vectors in node order; layer ``l`` holds the first ``sizes[l]`` nodes."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], layers: list[np.ndarray] | None = None):
        self.vectors, self.sizes = vectors, sizes
        self.layers = layers or [
            np.full((n, LINKS * (1 if level else 2)), -1, np.int32) for level, n in enumerate(sizes)
        ]

    @classmethod
    def build(cls, vectors: np.ndarray, tops: np.ndarray) -> Graph:
        """``tops`` are the top layers of the nodes, in falling order."""
        sizes = [int(np.searchsorted(-tops, -level, side="right")) for level in range(int(tops[0]) + 1)]
        graph = cls(vectors, sizes)
        at = 0
        while at < len(vectors):
            # the graph at most doubles with a block, so a block meets a graph of its kind
            end = min(at + max(1, min(at, BLOCK)), len(vectors))
            graph._enter(at, end, tops)
            at = end
        return graph

    def _enter(self, start: int, end: int, tops: np.ndarray) -> None:
        block = np.arange(start, end)
        own = self.vectors[block]
        near = None
        for level in range(len(self.sizes) - 1, -1, -1):
            known = min(start, self.sizes[level])
            mine = np.flatnonzero(tops[block] >= level)
            if known:
                width = BUILD_WIDTH if len(mine) else 1
                near, gaps = self._search(own, near, level, width, known)
            if not len(mine):
                continue
            among = block[mine]
            inner = _distances(own[mine][:, None], own[mine][None])
            np.fill_diagonal(inner, np.inf)
            keep = min(len(among), self.layers[level].shape[1] + 1)
            first = np.argsort(inner, axis=1, kind="stable")[:, :keep]
            nodes, away = among[first], np.take_along_axis(inner, first, 1)
            nodes[~np.isfinite(away)] = -1
            if known:
                nodes, away = np.concatenate([near[mine], nodes], axis=1), np.concatenate([gaps[mine], away], axis=1)
            chosen = self._choose(among, nodes, away, LINKS)
            self.layers[level][among, :LINKS] = chosen
            self._link_back(level, among, chosen)

    def _choose(self, nodes: np.ndarray, near: np.ndarray, gaps: np.ndarray, room: int) -> np.ndarray:
        """At most ``room`` of each node's candidates (-1 is none): spread ones first, then the nearest."""
        order = np.argsort(np.where(near < 0, np.inf, gaps), axis=1, kind="stable")
        near, gaps = np.take_along_axis(near, order, 1), np.take_along_axis(gaps, order, 1)
        points = self.vectors[near]
        taken = np.zeros(near.shape, bool)
        shadow = np.full(near.shape, np.inf)  # distance of each candidate to the nearest taken one
        for c in range(near.shape[1]):
            take = (near[:, c] >= 0) & (gaps[:, c] < shadow[:, c]) & (taken.sum(axis=1) < room)
            taken[:, c] = take
            rows = np.flatnonzero(take)
            if len(rows):
                away = _distances(points[rows], points[rows, c : c + 1])
                shadow[rows] = np.minimum(shadow[rows], away)
        spare = np.where(near < 0, 2, np.where(taken, 0, 1))
        order = np.argsort(spare, axis=1, kind="stable")[:, :room]
        out = np.take_along_axis(near, order, 1)
        if out.shape[1] < room:
            out = np.pad(out, ((0, 0), (0, room - out.shape[1])), constant_values=-1)
        return out

    def _link_back(self, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        layer = self.layers[level]
        room = layer.shape[1]
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        both = (layer[target] == source[:, None]).any(axis=1)  # linked from the other side already
        source, target = source[~both], target[~both]
        gap = _distances(self.vectors[source], self.vectors[target])
        order = np.lexsort((gap, target))
        source, target, gap = source[order], target[order], gap[order]
        ends, first, count = np.unique(target, return_index=True, return_counts=True)
        if not len(ends):
            return
        place = np.arange(len(target)) - np.repeat(first, count)
        fits = place < room
        row = np.repeat(np.arange(len(ends)), count)
        new = np.full((len(ends), room), -1, np.int32)
        new[row[fits], place[fits]] = source[fits]
        every = np.concatenate([layer[ends], new], axis=1)
        held = (every >= 0).sum(axis=1)
        roomy = held <= room
        packed = np.take_along_axis(every, np.argsort(every < 0, axis=1, kind="stable"), 1)[:, :room]
        layer[ends[roomy]] = packed[roomy]
        full = ends[~roomy]
        if len(full):
            near = every[~roomy]
            gaps = _distances(self.vectors[near], self.vectors[full][:, None])
            layer[full] = self._choose(full, near, gaps, room)

    def _search(self, queries: np.ndarray, entry: np.ndarray | None, level: int, width: int, known: int):
        """The nearest ``width`` nodes that each query meets in a layer, nearest first (-1: no more)."""
        layer = self.layers[level]
        n = len(queries)
        seen = np.zeros((n, known + 1), bool)  # the last place stands for no node
        seen[:, known] = True
        if entry is None:
            entry = np.zeros((n, 1), np.int32)
        near = np.where(entry < known, entry, -1).astype(np.int32)
        gaps = np.where(near < 0, np.inf, _distances(self.vectors[near], queries[:, None]))
        rows = np.arange(n)
        seen[rows[:, None], near] = True  # -1 is the last place
        order = np.argsort(gaps, axis=1, kind="stable")[:, :width]
        near, gaps = np.take_along_axis(near, order, 1), np.take_along_axis(gaps, order, 1)
        if near.shape[1] < width:
            more = ((0, 0), (0, width - near.shape[1]))
            near, gaps = np.pad(near, more, constant_values=-1), np.pad(gaps, more, constant_values=np.inf)
        open_ = near >= 0
        active = rows
        while len(active):
            waiting = np.where(open_[active], gaps[active], np.inf)
            best = waiting.argmin(axis=1)
            going = np.isfinite(waiting[np.arange(len(active)), best])
            active, best = active[going], best[going]
            if not len(active):
                break
            open_[active, best] = False
            found = layer[near[active, best]]
            found = np.where((found < known) & ~seen[active[:, None], found], found, -1)
            seen[active[:, None], found] = True
            some = (found >= 0).any(axis=1)
            rows_on = active[some]
            if not len(rows_on):
                continue
            found = found[some]
            away = np.full(found.shape, np.inf)
            r, c = np.nonzero(found >= 0)
            away[r, c] = _distances(self.vectors[found[r, c]], queries[rows_on[r]])
            every, dist = np.concatenate([near[rows_on], found], 1), np.concatenate([gaps[rows_on], away], 1)
            fresh = np.concatenate([open_[rows_on], found >= 0], 1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :width]
            near[rows_on] = np.take_along_axis(every, order, 1)
            gaps[rows_on] = np.take_along_axis(dist, order, 1)
            open_[rows_on] = np.take_along_axis(fresh, order, 1)
        return near, gaps

    def nearest(self, queries: np.ndarray, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
        done = []
        for start in range(0, len(queries), BLOCK):
            part, near = queries[start : start + BLOCK], None
            for level in range(len(self.sizes) - 1, -1, -1):
                near, gaps = self._search(part, near, level, 1 if level else width, self.sizes[level])
            done.append((near, gaps))
        return np.concatenate([n for n, _ in done]), np.concatenate([g for _, g in done])


def tops_of(keys: np.ndarray) -> np.ndarray:
    """Top layer of each node from its key: each layer up has a share of 1 / LINKS."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    share = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(share, 1e-15)) / np.log(LINKS)).astype(np.int64)


def _scale(points: np.ndarray) -> float:
    """A power of two that keeps squares in range; 1 for all but huge or tiny components."""
    most = float(np.abs(points).max(initial=0.0))
    return 1.0 if 1e-100 < most < 1e100 else float(2.0 ** -np.frexp(most)[1])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard from its classes: flat arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim = int(batch.column("dim")[i].as_py())
            members = batch.column("members")[i].values
            ids = members.field("ids")
            points = members.field("point").flatten().to_numpy().reshape(-1, dim).astype(np.float64)
            keys = ids.flatten().to_numpy()[np.r_[0, np.cumsum(ids.value_lengths().to_numpy())[:-1]]]
            tops = tops_of(keys)
            order = np.lexsort((keys, -tops))
            graph = Graph.build(points[order] * _scale(points), tops[order])
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "shard": pa.array([batch.column("shard")[i].as_py()], pa.int64()),
                    "points": [points[order].astype("<f8").tobytes()],
                    "ids": pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
                    "sizes": pa.array([graph.sizes], pa.list_(pa.int32())),
                    "links": [b"".join(layer.astype("<i4").tobytes() for layer in graph.layers)],
                }
            )


def _read(row: pa.RecordBatch) -> tuple[Graph, float]:
    dim = int(row.column("dim")[0].as_py())
    points = np.frombuffer(row.column("points")[0].as_py(), "<f8").reshape(-1, dim)
    sizes = row.column("sizes")[0].as_py()
    flat, layers, read = np.frombuffer(row.column("links")[0].as_py(), "<i4"), [], 0
    for level, n in enumerate(sizes):
        wide = LINKS * (1 if level else 2)
        layers.append(flat[read : read + n * wide].reshape(n, wide))
        read += n * wide
    scale = _scale(points)
    return Graph(points * scale, sizes, layers), scale


def _answer(count: int, width: int):
    """Search blocks of queries in their shard: the nearest rows of the shard for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                graph, scale = _read(row)
                asked = row.column("asked")[0].values
                own = asked.field("vec_id").to_numpy()
                queries = asked.field("point").flatten().to_numpy().reshape(len(own), -1).astype(np.float64)
                near, _ = graph.nearest(queries * scale, width)
                away = np.full(near.shape, np.inf)
                for q in range(len(own)):
                    away[q] = np.where(near[q] < 0, np.inf, _distances(graph.vectors[near[q]], queries[q] * scale) / scale)
                first, lists = np.argsort(away, axis=1, kind="stable"), row.column("ids")[0].as_py()
                out: list[tuple[int, int, float]] = []
                for q in range(len(own)):
                    got: list[tuple[float, int]] = []
                    for c in first[q]:
                        if near[q, c] < 0 or (len(got) >= count and away[q, c] > got[-1][0]):
                            break
                        got += [(float(away[q, c]), v) for v in lists[near[q, c]] if v != own[q]]
                        got = sorted(got)[:count]
                    out += [(int(own[q]), v, s) for s, v in got]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def usable(point: Column) -> Column:
    """True for a vector that takes part."""
    fine = F.forall(point, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(point, lambda x: x != 0), F.lit(False))


def _points(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    point = F.col(vector_col).cast("array<double>")
    valid = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), point.alias("point"))
    valid = valid.where(F.col("vec_id").isNotNull() & usable(F.col("point")))
    return valid.groupBy("vec_id").agg(F.min("point").alias("point"))


def build_index(vectors: DataFrame, count: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The graphs of all shards, one stored row each."""
    ship(vectors.sparkSession)
    points = _points(vectors, id_col, vector_col)
    # a class answers with its smallest ids, one of which may be the query itself
    part = F.pmod("vec_id", F.lit(_PARTS))
    place = F.row_number().over(Window.partitionBy("point", part).orderBy("vec_id"))
    some = points.withColumn("_place", place).where(F.col("_place") <= count + 1)
    listed = F.slice(F.array_sort(F.collect_list("vec_id")), 1, count + 1)
    classes = stored(some.groupBy("point").agg(listed.alias("ids")), "classes")
    held = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("point")), F.lit(0)).alias("components")).first()
    shards = max(1, -(-held.n // SHARD), -(-held.components // COMPONENTS))
    dealt = classes.select(
        F.size("point").alias("dim"),
        F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).alias("shard"),
        F.struct("ids", "point").alias("member"),
    )
    grouped = dealt.groupBy("dim", "shard").agg(F.collect_list("member").alias("members")).repartition(shards, "dim", "shard")
    index = grouped.mapInArrow(
        _build, "dim int, shard bigint, points binary, ids array<array<bigint>>, sizes array<int>, links binary"
    )
    return stored(index, "graphs")


def search(
    index: DataFrame,
    queries: DataFrame,
    count: int = NEAREST,
    width: int = SEARCH_WIDTH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of the index but the query itself, as found.

    ``index`` must have been built for at least ``count``.
    """
    ship(queries.sparkSession)
    asked = _points(queries, id_col, vector_col).withColumn("dim", F.size("point"))
    blocks = F.ceil(F.count(F.lit(1)) / ASKED).alias("blocks")
    asked = asked.join(asked.groupBy("dim").agg(blocks), "dim")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).alias("block")
    grouped = asked.groupBy("dim", block).agg(F.collect_list(F.struct("vec_id", "point")).alias("asked"))
    last = index.agg(F.max("shard")).first()[0]
    shards = F.sequence(F.lit(0).cast("bigint"), F.lit(last or 0).cast("bigint"))
    met = index.join(grouped.select("dim", "asked", F.explode(shards).alias("shard")), ["dim", "shard"])
    found = met.mapInArrow(_answer(count, width), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")
