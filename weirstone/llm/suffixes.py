"""Removal of byte strings of 50 bytes or more that an earlier document has too, by prefix doubling.

Every position of every text would be 16 bytes for each byte of text in each
sort, so the doubling runs on positions that equal strings are sure to share:

1. *Rank 20.*  Names of strings of 1, 2, 4, 8, 16 and 20 bytes are made by
   doubling, each from names at an offset.  Of the 31 strings of 20 bytes
   inside a string of 50, the one with the smallest name (leftmost of equals) is
   its anchor; equal strings of 50 have the same anchor at the same place.  One
   position in 16 is an anchor.  Neighbouring starts with one anchor form a run.
   Spark sorts the runs by the anchor's name and the name of the context, all
   the bytes that the run's strings of 50 cover.  Runs with an anchor that no
   other has are unique and leave; where an earlier document has the same
   context, the whole run is found.  This settles all but the first document of
   each group and the ends of matches.
2. *Rank 35.*  The strings of 50 whose anchor starts 0 to 15 bytes after their own start
   all cover the 35 bytes from the anchor on, all others the 36 bytes from 16 before it
   on.  The runs that are left are cut by these distances into parts, and Spark
   sorts the parts by the names of these bytes and of the part's own context, with the same
   outcome as in the first step: parts are unique and leave, are found whole, or are left.
3. *Rank 50.*  Each start that is left gets the pair of names of its strings of
   32 bytes at offsets 0 and 18, and Spark sorts 96 bits of the pairs: equal pairs are
   equal strings of 50.

The starts found cover the bytes to remove.  All strings are judged on the
input.  Texts are cut into pieces that overlap by 49 bytes, so no start is lost
and a task never holds more than a piece.

Repeats inside a task are folded before rows are sorted by a name: one row per
task stands for them, and the others, of which the result or the sharing is
known, travel by a number of their own.  So a string that a third of all rows
hold does not meet in one task.  Rows hold names and places only; the few
rounds that need bytes again read the texts again.

Defined results: a null text is empty; a text under 50 bytes loses nothing;
rows that repeat an id take nothing from each other; more than ``MAX_VARIANTS``
different texts under one id are refused with an error that names the id; a row
without id neither loses anything nor makes others lose; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import ship, slices, stored, with_company

LENGTH = 50
GRAM = 20
HALF = 32
RUN = LENGTH - GRAM + 1
# Starts with one anchor are cut by their distance from it into parts of so many; a part has LENGTH - PART + 1 bytes in common.
PART = 16
PIECE = 1 << 20
# Positions that are named at a time.
BLOCK = 1 << 14
_PLACE_BITS = 21
_NAMES = np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
# A run in one number: start, variant of a repeated id, anchor, last start, and what is known: nothing, shared, found.
# A text of Spark is under 2^31 bytes, so a start takes 31 bits.
_START, _VARIANT, _ANCHOR, _LAST = 32, 12, 7, 2
SHARED, FOUND = 1, 2
MAX_VARIANTS = 1 << (_START - _VARIANT)


def doubled(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of joined strings from the names of their parts."""
    out = left * _MIX[0]
    out ^= out >> np.uint64(32)
    out += right
    out *= _MIX[1]
    out ^= out >> np.uint64(29)
    return out


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the strings of ``GRAM`` and ``HALF`` bytes at all positions."""
    gram, half = (np.empty(max(len(data) - n + 1, 0), np.uint64) for n in (GRAM, HALF))
    # block by block, so that the names of shorter strings stay in the processor's cache
    for begin in range(0, len(gram), BLOCK):
        one = _NAMES[data[begin : begin + BLOCK + HALF - 1]]
        two = doubled(one[:-1], one[1:])
        four = doubled(two[:-2], two[2:])
        eight = doubled(four[:-4], four[4:])
        sixteen = doubled(eight[:-8], eight[8:])
        own = gram[begin : begin + BLOCK]
        own[:] = doubled(sixteen[: len(own)], four[16 : 16 + len(own)])
        own = half[begin : begin + BLOCK]
        own[:] = doubled(sixteen[: len(own)], sixteen[16 : 16 + len(own)])
    return gram, half


def runs(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of starts with one anchor.

    Piece, first start, anchor and last start from it, name of the anchor, name of the context.
    """
    lengths = np.array([len(p) for p in pieces])
    offsets = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(pieces), np.uint8)
    counts = lengths - LENGTH + 1
    gram, half = names(data)
    place = np.uint64(_PLACE_BITS)
    least = ((gram >> place) << place) | np.arange(len(gram), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        least = np.minimum(least[:-step], least[step:])
    least = np.minimum(least[: -(RUN - 16)], least[RUN - 16 :])
    start = np.repeat(offsets - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    anchor = (least[start] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    low, high, at = start[first], start[last], anchor[first]
    piece = np.searchsorted(offsets, low, "right") - 1
    # a context of 50 to 80 bytes is the strings of 32 at its start, 18 on, and at its end, and where the anchor is
    context = doubled(doubled(half[low], half[low + LENGTH - HALF]), half[high + LENGTH - HALF])
    context = doubled(context, ((at - low) * 64 + high - low).view(np.uint64))
    return piece, low - offsets[piece], at - low, high - low, gram[at], context


def _cut(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of pieces (text, offset, bytes) of bounded size; pieces of a text overlap so that each start is in one."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            piece = text[offset : offset + PIECE + LENGTH - 1]
            if held and held + len(piece) > PIECE + LENGTH:
                yield group
                group, held = [], 0
            group.append((i, offset, piece))
            held += len(piece)
    if group:
        yield group


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [v or b"" for v in batch.column("_bytes").to_pylist()]


def _numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _folded(
    key: np.ndarray, doc: np.ndarray, packed: np.ndarray, same: np.ndarray | None = None, last: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Keys to sort by, and what is known, for rows of one task.

    Of rows with one key the first by document goes by it; the others get a
    number of their own.  Those are found if they are of a later document and,
    where ``same`` is given, equal in it too; else they are known to be shared
    and looked at again, or, in the last round, go by their key as well.
    """
    if not len(key):
        return key, np.empty(0, np.int64)
    order = np.argsort(key)
    k = key[order]
    twice = np.append(False, k[1:] == k[:-1])
    twice[:-1] |= twice[1:]
    # few keys are there twice: only those are put in order by the rest as well
    few = order[twice]
    order[twice] = few[np.lexsort((doc[few], same[few], key[few]) if same is not None else (doc[few], key[few]))]
    k, d = key[order], doc[order]
    part = np.append(False, k[1:] == k[:-1])
    equal = part if same is None else part & np.append(False, same[order][1:] == same[order][:-1])
    begin = np.maximum.accumulate(np.where(equal, 0, np.arange(len(k))))
    found = equal & (d > d[begin])
    # the first goes by its key, and is known to be shared only if one of the others is left
    left = part & ~found
    groups = np.flatnonzero(~part)
    left[groups] = np.logical_or.reduceat(left, groups)
    known, out = np.empty(len(k), np.int64), np.empty(len(k), np.uint64)
    known[order] = np.where(found, FOUND, np.where(left, SHARED, 0))
    out[order] = np.where(found if last else part, doubled(d.view(np.uint64), packed[order].view(np.uint64)), k)
    return out, known


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartition("h").sortWithinPartitions("h", *more)


def _anchored(docs: DataFrame) -> DataFrame:
    """All runs by the name ``h`` of the anchor: name ``c`` of the context, document, packed run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_bytes", PIECE):
            ids, variants = _numbers(part, "_id"), _numbers(part, "_variant")
            for group in _cut(_texts(part)):
                piece, low, at, high, name, context = runs([p for _, _, p in group])
                owner = np.array([i for i, _, _ in group])[piece]
                start = low + np.array([o for _, o, _ in group])[piece]
                packed = (start << _START) | (variants[owner] << _VARIANT) | (at << _ANCHOR) | (high << _LAST)
                key, known = _folded(name, ids[owner], packed, context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(ids[owner]), pa.array(packed | known)],
                    names=["h", "c", "_id", "run"],
                )

    return _sorted(docs.mapInArrow(run, "h bigint, c bigint, _id bigint, run bigint"), "c", "_id")


def _shared(rows: DataFrame) -> DataFrame:
    """Runs that are found, and those to look at again: ``_id``, ``run``, ``found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch, company in with_company(batches, "h"):
            h, c, ids, packed = (batch.column(n).to_numpy() for n in ("h", "c", "_id", "run"))
            known = packed & 3
            same_h = np.append(before is not None and h[0] == before[0], h[1:] == h[:-1])
            same_c = same_h & np.append(before is not None and c[0] == before[1], c[1:] == c[:-1])
            begin = np.maximum.accumulate(np.where(same_c, -1, np.arange(len(h))))
            first = np.where(begin < 0, before[2] if before else 0, ids[np.maximum(begin, 0)])
            found = (known == FOUND) | (same_c & (ids > first))
            # an anchor with one context only has nothing more to find; groups at the ends of a batch are not told
            starts = np.flatnonzero(~same_h)
            group = np.cumsum(~same_h)
            several = np.ones(len(h), bool)
            if len(starts) > 1:
                contexts = np.add.reduceat((~same_c).astype(int) + (known == SHARED), starts)
                inside = (group > 1 - int(not same_h[0])) & (group < group[-1])
                several[inside] = (contexts > 1)[group[inside] - 1]
            keep = found | ((company | (known == SHARED)) & several)
            before = (h[-1], c[-1], int(first[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(packed), pa.array(found)], names=["_id", "run", "found"]
            ).filter(pa.array(keep))

    return rows.mapInArrow(run, "_id bigint, run bigint, found boolean")


def _variant() -> Column:
    return F.shiftright("run", _VARIANT).bitwiseAND(F.lit(MAX_VARIANTS - 1)).alias("_variant")


def _with_runs(docs: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with the runs of each document."""
    by_doc = rows.groupBy("_id", _variant()).agg(F.collect_list("run").alias("runs"))
    return docs.join(by_doc, ["_id", "_variant"], how).select("_id", "_bytes", "runs")


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts by pieces: document, packed run, place of its start in the names of strings of 32, and these."""
    for part in slices(batches, "_bytes", PIECE):
        ids, texts, lists = _numbers(part, "_id"), _texts(part), part.column("runs")
        packed = [np.sort(lists[i].values.to_numpy()) for i in range(len(texts))]
        for group in _cut(texts):
            offset, docs, rows, places = 0, [], [], []
            for i, begin, piece in group:
                low, high = np.searchsorted(packed[i] >> _START, [begin, begin + PIECE])
                own = packed[i][low:high]
                docs.append(np.full(len(own), ids[i]))
                rows.append(own)
                places.append((own >> _START) - begin + offset)
                offset += len(piece)
            # runs reach over the end of a piece by less than its overlap only if their strings do, and those are whole
            half = names(np.frombuffer(b"".join(p for _, _, p in group), np.uint8))[1]
            yield np.concatenate(docs), np.concatenate(rows), np.concatenate(places), half


def _parts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The runs again, cut by distance from the anchor, by the name of what the strings of a part have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, packed, place, half in _halves(batches):
            at, last = (packed >> _ANCHOR) & 31, (packed >> _LAST) & 31
            rest = packed & (MAX_VARIANTS - 1 << _VARIANT)
            for near in range(0, RUN, PART):
                far = min(near + PART, RUN) - 1
                low, high = np.maximum(0, at - far), np.minimum(last, at - near)
                some = low <= high
                where = (place + at - near)[some]
                name = doubled(half[where], half[where + LENGTH - HALF - (far - near)])
                name = doubled(name, np.full(len(name), near, np.uint64))
                begin, more = (place + low)[some], (high - low)[some]
                context = doubled(doubled(half[begin], half[begin + LENGTH - HALF]), half[begin + more + LENGTH - HALF])
                context = doubled(context, ((at - low)[some] * 64 + more).view(np.uint64))
                start = (packed[some] >> _START) + low[some]
                cut = (start << _START) | rest[some] | (more << _LAST)
                key, known = _folded(name, doc[some], cut, context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc[some]), pa.array(cut | known)],
                    names=["h", "c", "_id", "run"],
                )

    named = _with_runs(docs, rows).mapInArrow(run, "h bigint, c bigint, _id bigint, run bigint")
    return _shared(_sorted(named, "c", "_id"))


def _ends(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Starts found one by one, each as a run of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, packed, place, half in _halves(batches):
            count = ((packed >> _LAST) & 31) + 1
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(packed >> _START, count) + step
            cut = (start << _START) | np.repeat(packed & (MAX_VARIANTS - 1 << _VARIANT), count)
            where, owner = np.repeat(place, count) + step, np.repeat(doc, count)
            left, right = half[where], half[where + LENGTH - HALF]
            key, known = _folded(doubled(left, right), owner, cut, left, last=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(right.astype(np.uint32).view(np.int32)), pa.array(owner), pa.array(cut | known)],
                names=["h", "c", "_id", "run"],
            )

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, c, ids, packed = (batch.column(n).to_numpy() for n in ("h", "c", "_id", "run"))
            same = np.append(False, (h[1:] == h[:-1]) & (c[1:] == c[:-1]))
            same[0] = before is not None and (h[0], c[0]) == before[:2]
            begin = np.maximum.accumulate(np.where(same, -1, np.arange(len(h))))
            first = np.where(begin < 0, before[2] if before else 0, ids[np.maximum(begin, 0)])
            before = (h[-1], c[-1], int(first[-1]))
            yield batch.filter(pa.array((packed & 3 == FOUND) | (same & (ids > first)))).select(["_id", "run"])

    named = _with_runs(docs, rows).mapInArrow(run, "h bigint, c int, _id bigint, run bigint")
    return _sorted(named, "c", "_id").mapInArrow(later, "_id bigint, run bigint")


def _numbered(docs: DataFrame, id_col: str, text_col: str, max_variants: int = MAX_VARIANTS) -> DataFrame:
    """``_id``, ``_variant`` and ``_bytes``: texts that share an id are told apart by a variant number."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    marked = rows.withColumn("_mark", F.xxhash64("_text"))
    twice = marked.groupBy("_id").agg(F.min("_mark").alias("a"), F.max("_mark").alias("b")).where("a < b").select("_id")
    marks = marked.select("_id", "_mark").join(twice, "_id", "left_semi").distinct()
    several = F.concat(F.lit("too many different texts under id "), F.col("_id"))
    counts = marks.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    refused = F.when(F.col("_n") > max_variants, F.raise_error(several)).otherwise(F.lit(0))
    counted = counts.select("_id", refused.cast("int").alias("_zero"))
    lists = marks.join(counted, "_id").groupBy("_id", "_zero").agg(F.array_sort(F.collect_list("_mark")).alias("m"))
    marks = stored(
        lists.select("_id", "_zero", F.posexplode("m").alias("_place", "_mark")).select(
            "_id", "_mark", (F.col("_place") + F.col("_zero")).alias("_variant")
        ),
        "variants",
    )
    joined = marked.join(marks, ["_id", "_mark"], "left")
    return joined.select("_id", F.coalesce("_variant", F.lit(0)).alias("_variant"), F.col("_text").cast("binary").alias("_bytes"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the remaining bytes ``kept`` of every row."""
    ship(docs.sparkSession)
    rows = _numbered(docs, id_col, text_col)
    named = rows.where("_id IS NOT NULL")
    shared = stored(_shared(_anchored(named)), "anchors")
    open_ = stored(_parts(named, shared.where("NOT found").select("_id", "run")), "open")
    ends = stored(_ends(named, open_.where("NOT found").select("_id", "run")), "ends")
    found = shared.union(open_).where("found").select("_id", "run").union(ends)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_bytes", PIECE):
            out = []
            for text, packed in zip(_texts(part), part.column("runs"), strict=True):
                if not packed.is_valid:
                    out.append((len(text), 0, 0, text))
                    continue
                p = packed.values.to_numpy()
                start = p >> _START
                change = np.bincount(start, minlength=len(text) + 1) - np.bincount(
                    start + ((p >> _LAST) & 31) + LENGTH, minlength=len(text) + 1
                )
                gone = np.cumsum(change)[: len(text)] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = _with_runs(rows, found, "left")
    return joined.mapInArrow(run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
