"""Exact join of documents whose word shingles have a Jaccard similarity of 0.8 or more.

Jaccard distance is a metric, and the join divides its space by pivots, twice.

* **Outer pivots are single shingles.**  Whole documents are useless as first
  pivots: two unrelated texts share nothing, so every distance is 1 and every
  window reaches everywhere.  A document's distance to the pivot {s} is below 1
  exactly if s is one of its shingles, and its home is the region of the rarest
  of them.  Two documents within the threshold share so much that one of the
  ``n - ceil(0.8 n) + 1`` rarest shingles of either is also among those of the
  other; that many regions are the window a document is copied to.
* **Inner pivots are documents.**  In each region the most typical document
  (the largest part of its window shared with others) is the pivot, and all
  members are measured against it: members within the threshold link to it, and
  so to each other, without any pair among them.  What is not one component
  afterwards is divided again, by cell of pivot and not by region: up to
  ``PIVOTS`` further members of each cell, typical ones apart from the pivot's
  component, are measured against the cell, as long as that takes away half of
  what is left.  Then the members of a cell meet, but only those in different
  components whose sizes allow a link, whose distances to the pivot differ by
  0.2 at most, and whose marked regions leave room for as many in common as a
  link of their sizes takes.

Every distance is computed on the whole sets, so links are exact.  Equal sets
are one class from the start; a large group of copies is one row.  Rare means
few in a table of shingle counts over all documents, by hash, of fixed size;
any such order gives the same result.

Only what contracts need is returned: classes, components, and the links that
prove them.

Defined results: a text without words has no shingles, links with nothing and
is its own component; a row without id links with nothing and has no component;
rows that repeat an id are in one component if their sets are; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import bytes_of, ship, slices, stored, with_company
from weirstone.llm.links import components

SHINGLE = 5
PERCENT = 80
COUNT_BITS = 18
# Words of 64 bits that mark the regions of a set.
MARKS = 4
# Pivots that a cell is divided by at a time.
PIVOTS = 8
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) & (1 << 64) - 1 | 1 for i in range(SHINGLE + 1)], np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The set of a text, as sorted 64-bit hashes."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    mixed = np.full(count, width, np.uint64) * _ODD[SHINGLE]
    for k in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[0] + hashed[k : k + count] * _ODD[k]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def window(n: int) -> int:
    """Regions that a set of ``n`` shingles is copied to."""
    return n - -(-PERCENT * n // 100) + 1


def counts(docs: DataFrame) -> np.ndarray:
    """How often shingles of each hash prefix occur in ``_text`` of all documents; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for part in slices(batches, "_text"):
            for text in bytes_of(part, "_text"):
                total += np.bincount(shingles(text) >> np.uint64(64 - COUNT_BITS), minlength=len(total)) if text else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "n"])

    rows = docs.select("_text").mapInArrow(run, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    found = np.array([tuple(r) for r in rows.collect()], np.int64).reshape(-1, 2)
    table = np.zeros(1 << COUNT_BITS, np.int64)
    table[found[:, 0]] = found[:, 1]
    return table


def sketched(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``_id``, size ``n``, ``digest`` of the set and its ``rare`` shingles, for ``_id``, ``_text``."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for part in slices(batches, "_text"):
            sizes, digests, rare = [], [], []
            for text in bytes_of(part, "_text"):
                own = shingles(text)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                order = np.argsort(often[own >> np.uint64(64 - COUNT_BITS)], kind="stable")
                rare.append(own[order[: window(len(own))]].view(np.int64) if len(own) else own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(rare, pa.list_(pa.int64())),
                ],
                names=["_id", "n", "digest", "rare"],
            )

    return docs.select("_id", "_text").mapInArrow(run, "_id bigint, n bigint, digest binary, rare array<bigint>")


def regions(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of all regions with two members or more: ``h``, ``cid``, ``n``, ``c`` (regions a class is in).

    The rows come sorted by region, so nothing but one row is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, mask in with_company(batches, "h"):
            yield batch.filter(pa.array(mask))

    own = sketches.join(classes.select("digest", "_id", "cid"), ["digest", "_id"])
    rows = own.select(F.explode("rare").alias("h"), "cid")
    kept = stored(rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, rows.schema), "regions").distinct()
    shared = kept.groupBy("cid").agg(F.count(F.lit(1)).alias("c")).join(classes.select("cid", "n"), "cid")
    return kept.join(shared, "cid").select("h", "cid", "n", "c")


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid`` and the whole set ``s`` of the classes in ``wanted`` (``cid``, ``_id`` of one member, ``digest``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            out, keep = [], []
            for text, digest in zip(bytes_of(part, "_text"), part.column("digest").to_pylist(), strict=True):
                own = shingles(text)
                keep.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() == digest)
                out.append(own.view(np.int64))
            rows = pa.RecordBatch.from_arrays([part.column("cid"), pa.array(out, pa.list_(pa.int64()))], names=["cid", "s"])
            yield rows.filter(pa.array(keep, pa.bool_()))

    joined = docs.join(wanted.select("cid", "_id", "digest"), "_id").select("cid", "digest", "_text")
    return joined.mapInArrow(run, "cid bigint, s array<bigint>")


def _may_link(a: str, b: str) -> Column:
    """Whether sizes allow a link, and each is in as many shared regions as that takes."""
    sizes = 100 * F.least(f"{a}_n", f"{b}_n") >= PERCENT * F.greatest(f"{a}_n", f"{b}_n")
    return sizes & (F.least(f"{a}_c", f"{b}_c") >= _common(f"{a}_n", f"{b}_n"))


def _common(a: str, b: str) -> Column:
    """Regions that two sets of these sizes have in common at least if they link.

    They share ``ceil(0.8 / 1.8 (a + b))`` shingles at least.  Of the window of
    the larger, only as many are not shared as its size is above that, and the
    shared ones among the rarest of one are among the rarest of the other.
    """
    both = F.ceil(PERCENT * (F.col(a) + F.col(b)) / (100 + PERCENT))
    return 1 + both - F.ceil(PERCENT * F.greatest(a, b) / 100)


def measured(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a``, ``b``, distance ``d`` and ``linked`` of distinct pairs (``a``, ``b``, ``a_n``, ``b_n``).

    A repeated id may bring a set twice, so the rows are made distinct at the end.
    """
    named = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    found = stored(sets(docs, classes.join(named, "cid", "left_semi")), "sets")
    own, other = (found.select(F.col("cid").alias(c), F.col("s").alias(f"{c}_s")) for c in ("a", "b"))
    both = pairs.join(own, "a").join(other, "b")
    met = both.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("all"), F.size(F.array_intersect("a_s", "b_s")).alias("i"))
    return met.select(
        "a",
        "b",
        (1 - F.col("i") / (F.col("all") - F.col("i"))).alias("d"),
        (100 * F.col("i") >= PERCENT * (F.col("all") - F.col("i"))).alias("linked"),
    ).distinct()


def _first_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pivot of each region, and the distinct pairs of members with their pivots.

    Pairs that have few regions with this pivot in common are left to the second step.
    """
    rank = F.struct(F.col("c") / F.col("n"), F.xxhash64("cid"), "cid", "n", "c")
    best = members.groupBy("h").agg(F.max(rank).alias("p"))
    pivots = best.select("h", F.col("p.cid").alias("b"), F.col("p.n").alias("b_n"), F.col("p.c").alias("b_c"))
    met = (
        members.select("h", F.col("cid").alias("a"), F.col("n").alias("a_n"), F.col("c").alias("a_c"))
        .join(pivots, "h")
        .where((F.col("a") != F.col("b")) & _may_link("a", "b"))
    )
    pairs = met.groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("k"))
    return pivots, pairs.where(4 * F.col("k") >= _common("a_n", "b_n")).drop("k")


def _cells(members: DataFrame, pivots: DataFrame, known: DataFrame, roots: DataFrame) -> DataFrame:
    """The cells of document pivots: ``p``, ``cid``, ``n``, ``c``, ``root``, bounds ``low``, ``high`` and ``m0``...

    A cell holds the members of all regions that have its pivot and are not one
    component yet; any two that may still link are in a cell together.  The bounds
    are those of the distance to the pivot, ``c`` counts the regions of a member
    that are in some cell, and the ``m`` columns mark them in ``MARKS`` words of 64 bits.
    """
    placed = members.select("h", "cid", "n").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "cid"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    away = stored(placed.join(mixed.select("h"), "h", "left_semi"), "away")
    marks = [
        F.coalesce(F.expr(f"bit_or(if(h & {MARKS - 1} = {i}, shiftleft(1L, cast(shiftright(h, 8) & 63 as int)), 0L))"), F.lit(0)).alias(f"m{i}")
        for i in range(MARKS)
    ]
    sided = away.groupBy("cid", "n", "root").agg(F.count(F.lit(1)).alias("c"), *marks)
    distances = known.select(F.col("a").alias("cid"), F.col("b").alias("p"), "d").union(
        known.select(F.col("b").alias("cid"), F.col("b").alias("p"), F.lit(0.0).alias("d")).distinct()
    )
    centres = pivots.select("h", F.col("b").alias("p"), F.col("b_n").alias("p_n"))
    places = away.select("h", "cid").join(centres, "h").select("p", "p_n", "cid").distinct()
    met = places.join(sided, "cid").join(distances, ["cid", "p"], "left")
    low = F.coalesce("d", 1 - F.least("n", "p_n") / F.greatest("n", "p_n")).alias("low")
    return met.select("p", "cid", "n", "c", "root", low, F.coalesce("d", F.lit(1.0)).alias("high"), *(f"m{i}" for i in range(MARKS)))


def _met(cells: DataFrame, others: DataFrame) -> DataFrame:
    """Distinct pairs of ``cells`` and ``others`` that are not one component, as far as the windows allow a link.

    Two sets differ in as many regions as their marks do, at least.
    """
    sides = ("cid", "n", "c", "root", "low", "high", *(f"m{i}" for i in range(MARKS)))
    x, y = (t.select("p", *(F.col(c).alias(f"{s}_{c}") for c in sides)) for t, s in ((cells, "a"), (others, "b")))
    reach = F.lit(1 - PERCENT / 100 + 1e-9)
    near = (F.col("a_low") - F.col("b_high") <= reach) & (F.col("b_low") - F.col("a_high") <= reach)
    differ = sum((F.bit_count(F.col(f"a_m{i}").bitwiseXOR(F.col(f"b_m{i}"))) for i in range(MARKS)), F.lit(0))
    common = F.col("a_c") + F.col("b_c") - differ >= 2 * _common("a_n", "b_n")
    order = F.col("a_cid") < F.col("b_cid")
    fits = near & common & (F.col("a_root") != F.col("b_root")) & _may_link("a", "b")
    found = x.join(y, "p").where(fits & (order if others is cells else F.col("a_cid") != F.col("b_cid")))
    sizes = [F.when(order, F.col(m)).otherwise(F.col(o)) for m, o in (("a_n", "b_n"), ("b_n", "a_n"))]
    ends = [F.least("a_cid", "b_cid").alias("a"), F.greatest("a_cid", "b_cid").alias("b")]
    return found.select(*ends, sizes[0].alias("a_n"), sizes[1].alias("b_n")).distinct()


def _open(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """``cells`` with the components of ``roots``, without the cells that are one component."""
    placed = cells.withColumnRenamed("root", "_old").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    placed = placed.withColumn("root", F.coalesce("root", "_old")).drop("_old")
    mixed = placed.groupBy("p").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return placed.join(mixed.select("p"), "p", "left_semi")


def _further(cells: DataFrame) -> DataFrame:
    """Rows of up to ``PIVOTS`` members of each cell, the most typical ones apart from the pivot's component."""
    centre = cells.where("cid = p").select("p", F.col("root").alias("_at"))
    apart = cells.join(centre, "p", "left").where("_at IS NULL OR root <> _at").drop("_at")
    rest = [c for c in apart.columns if c != "p"]
    rank = F.struct((F.col("c") / F.col("n")).alias("_r"), F.xxhash64("cid").alias("_x"), *rest)
    best = apart.groupBy("p", F.pmod(F.xxhash64("cid"), F.lit(PIVOTS)).alias("_slot")).agg(F.max(rank).alias("_best"))
    return best.select("p", *(f"_best.{c}" for c in rest))


def _size(cells: DataFrame) -> tuple[int, int]:
    """Rows of ``cells``, and pairs of their members that are in different components."""
    parts = cells.groupBy("p", "root").agg(F.count(F.lit(1)).alias("k"))
    both = parts.groupBy("p").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("same"))
    row = both.agg(F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs")).first()
    return int(row["n"] or 0), int(row["pairs"] or 0)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    sketches = stored(sketched(rows, counts(rows)), "sketches")
    own = sketches.where("n > 0 AND _id IS NOT NULL")
    grouped = own.groupBy("digest", "n").agg(F.min("_id").alias("_id"))
    classes = stored(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = stored(regions(own, classes), "members")
    pivots, pairs = _first_pairs(members)
    pivots, pairs = stored(pivots, "pivots"), stored(pairs, "pairs")
    known = stored(measured(pairs, rows, classes), "distances")
    links = known.where("linked").select("a", "b")
    roots = stored(components(links), "roots")
    cells = stored(_open(_cells(members, pivots, known, roots), roots), "cells")
    done = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    n, left = _size(cells)
    while left:
        # cells are divided by further pivots while that takes away half of what is left; then the rest is met
        last = left <= PIVOTS * n
        pairs = stored(_met(cells, cells if last else _further(cells)).join(done, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            known = stored(measured(pairs, rows, classes), "distances")
            done = done.union(known.select("a", "b"))
            later = known.where("linked").select("a", "b")
            # the stars found so far stand for the links that made them
            roots = stored(components(roots.select("node", "root").where("node <> root").union(later)), "roots")
        if last:
            break
        cells = stored(_open(cells, roots), "cells")
        before, (n, left) = left, _size(cells)
        if 2 * left > before:
            n = left
    named = classes.join(roots, classes.cid == roots.node, "left").select("digest", "_id", F.coalesce("root", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("_id").alias("component_id"))
    by_set = named.join(least, "root").select("digest", "component_id")
    linked = own.select("_id", "n", "digest").join(by_set, "digest", "left")
    alone = sketches.where("n = 0 OR _id IS NULL").select("_id", "n", F.col("_id").alias("component_id"))
    every = linked.select("_id", "n", "component_id").union(alone)
    return every.select(F.col("_id").alias("id"), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that a smaller id of their component stands for.

    Rows that repeat an id go or stay together; a row without id stays.
    """
    found = near_duplicates(docs, id_col, text_col)
    dropped = found.where("component_id < id").select(F.col("id").alias("_gone")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("bigint").alias("_id"))
    return rows.join(dropped, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")
