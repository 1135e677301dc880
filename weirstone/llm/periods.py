"""Runs of a text, stretches of words that repeat with a period, by internal pattern matching.

The documents of a task are worked on together, in groups of bounded size: their
words become one sequence of numbers, and a number of its own ends each document,
so that nothing matches across that end.

* Prefix doubling ranks all blocks of 1, 2, 4, ... words and sorts the suffixes as
  far as blocks repeat.  The places where one block occurs are a range of the
  suffix array.
* A wavelet tree over the suffix array answers, for a range of it, what the next
  and the previous place to a given one is (range successor).
* A run of period q is at least 4 q long.  With b the power of two in (q, 2 q], it
  holds a block of b words that begins at a multiple of b, and the same block
  q words before or after.  No occurrence lies nearer, since that distance would
  be a smaller period.  So the blocks of b words ask for their neighbouring
  occurrences, and distances in [b / 2, b) are the candidate periods, the first
  step of the progression of occurrences.
* Blocks equal at a distance stretch to both sides by comparing ranks of blocks of
  falling size.  A stretch that is long enough is a run; every run is found by
  each of its blocks and kept once.

Cases.  Null and empty texts have no words and no runs.  A null key is never
taken for a planted one.  Rows with one id are worked on one by one.  An empty
table gives no rows.  Of other columns nothing is read but what is carried
along.  Texts are never cut; one text may be as long as a row may be.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import bytes_of, ship, slices

LEAST_LENGTH = 6
LEAST_REPEATS = 4
# Text bytes that are worked on together, or one text.
GROUP_BYTES = 2 << 20


def block_ranks(words: np.ndarray, widest: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Ranks of blocks of 1, 2, 4, ... words, and the suffix array.

    For each size a pair of arrays by place: the range of the suffix array that
    the block at this place has.  Sizes end where no block repeats or at ``widest``.
    Blocks that reach past the end are unlike all others.
    """
    total = len(words)
    order = np.argsort(words, kind="stable").astype(np.int32)
    low, high = _ranges(words[order], order, np.zeros(total, np.int64), np.arange(total))
    levels = [(low, high)]
    size = 1
    while 2 * size <= widest:
        open_ = np.flatnonzero(high - low > 1)
        if not len(open_):
            break
        second = np.full(len(open_), -1, np.int64)
        inside = open_ + size < total
        second[inside] = low[open_[inside] + size]
        # a block past the end is unlike all others, and so are two of them
        second[~inside] = -1 - open_[~inside]
        key = low[open_].astype(np.int64) * (2 * total + 2) + second + total + 1
        by = np.argsort(key, kind="stable")
        places, key = open_[by], key[by]
        first = low[places]
        starts = np.r_[True, first[1:] != first[:-1]]
        slots = first + np.arange(len(places)) - np.maximum.accumulate(np.where(starts, np.arange(len(places)), 0))
        order[slots] = places
        new_low, new_high = _ranges(key, places, None, slots)
        low, high = low.copy(), high.copy()
        low[places], high[places] = new_low, new_high
        levels.append((low, high))
        size *= 2
    return levels, order


def _ranges(key: np.ndarray, places: np.ndarray, by_place: np.ndarray | None, slots: np.ndarray):
    """Range of the suffix array of each group of equal keys; by place, or in the order given."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[edge, len(key)])
    low = np.repeat(slots[edge], count).astype(np.int32)
    high = (low + np.repeat(count, count)).astype(np.int32)
    if by_place is None:
        return low, high
    out_low, out_high = np.empty(len(key), np.int32), np.empty(len(key), np.int32)
    out_low[places], out_high[places] = low, high
    return out_low, out_high


class WaveletTree:
    """Bit planes of a sequence, the highest bit first, each plane sorted by the bits before it."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(len(values) - 1).bit_length(), 1)
        self.planes: list[tuple[np.ndarray, int]] = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1 == 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.planes.append((ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range are less than its bound."""
        low, high = low.astype(np.int32), high.astype(np.int32)
        count = np.zeros(len(low), np.int32)
        for depth, (ones, zeros) in enumerate(self.planes):
            bit = (bound >> (self.bits - 1 - depth)) & 1 == 1
            l1, h1 = ones[low], ones[high]
            l0, h0 = low - l1, high - h1
            count += np.where(bit, h0 - l0, 0)
            low, high = np.where(bit, zeros + l1, l0), np.where(bit, zeros + h1, h0)
        return count

    def value(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The value of each range that has ``place`` smaller ones in it."""
        low, high, place = low.astype(np.int32), high.astype(np.int32), place.astype(np.int32)
        out = np.zeros(len(low), np.int32)
        for ones, zeros in self.planes:
            l1, h1 = ones[low], ones[high]
            l0, h0 = low - l1, high - h1
            bit = place >= h0 - l0
            place = place - np.where(bit, h0 - l0, 0)
            low, high = np.where(bit, zeros + l1, l0), np.where(bit, zeros + h1, h0)
            out = out << 1 | bit
        return out

    def neighbours(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next and previous value to ``at``, which each range holds; -1 where there is none."""
        mine = self.below(low, high, at)
        after, before = np.full(len(at), -1, np.int64), np.full(len(at), -1, np.int64)
        more, less = mine + 1 < high - low, mine > 0
        after[more] = self.value(low[more], high[more], mine[more] + 1)
        before[less] = self.value(low[less], high[less], mine[less] - 1)
        return after, before


def _stretch(levels: list[tuple[np.ndarray, np.ndarray]], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` on equal those from ``b`` on; with step -1 the words before both, backwards."""
    total = len(levels[0][0])
    length = np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        rank, size = levels[k][0], 1 << k
        active = np.arange(len(a))
        while len(active):
            shift = length[active]
            x, y = (a[active] + shift, b[active] + shift) if step > 0 else (a[active] - shift - size, b[active] - shift - size)
            inside = (x >= 0) & (np.maximum(x, y) < total)
            active, x, y = active[inside], x[inside], y[inside]
            active = active[rank[x] == rank[y]]
            length[active] += size
            if k + 1 < len(levels):  # longer equal blocks are taken already, so this size fits once at most
                break
    return length


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence whose documents have at most ``longest`` words."""
    levels, order = block_ranks(words, max(longest // LEAST_REPEATS * 2, 2))
    if len(levels) < 2:
        return np.zeros((0, 3), np.int64)
    tree = WaveletTree(order)
    pairs = []
    for k in range(1, len(levels)):
        low, high = levels[k]
        size = 1 << k
        at = np.arange(0, len(words), size)
        at = at[high[at] - low[at] > 1]
        if not len(at):
            continue
        after, before = tree.neighbours(low[at], high[at], at)
        for near, other in ((after - at, at), (at - before, before)):
            found = (np.where(other == at, after, before) >= 0) & (near >= size // 2) & (near < size)
            pairs.append(np.stack([other[found], near[found]], axis=1))
    every = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
    if not len(every):
        return np.zeros((0, 3), np.int64)
    at, period = every[:, 0], every[:, 1]
    back = _stretch(levels, at, at + period, -1)
    ahead = _stretch(levels, at, at + period, 1)
    runs = np.stack([at - back, back + ahead + period, period], axis=1)
    enough = runs[:, 1] >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * period)
    return np.unique(runs[enough], axis=0)


def plant(count: int, key: int | None) -> np.ndarray | None:
    """Where the words of a document come from, if its key plants a period into it."""
    if key is None or key % 10 or not count:
        return None
    g = key // 10
    start = g % count
    period = 1 + (count - start) // (3 + g % 8)
    source = np.arange(count)
    source[start:] = start + (source[start:] - start) % period
    return source


def _sequence(texts: list[list[bytes]], keys: list[int | None]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Word numbers of all documents with an end of its own behind each, the starts, and what is planted."""
    coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy()
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    words = np.arange(len(coded.dictionary), len(coded.dictionary) + int(starts[-1]), dtype=np.int64)
    sources: list[np.ndarray | None] = []
    read = 0
    for i, text in enumerate(texts):
        own = codes[read : read + len(text)]
        source = plant(len(text), keys[i])
        words[starts[i] : starts[i] + len(text)] = own if source is None else own[source]
        sources.append(source)
        read += len(text)
    return words, starts, sources


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for part in slices(batches, "text", GROUP_BYTES):
        texts = [t.split() for t in bytes_of(part, "text")]
        words, starts, sources = _sequence(texts, part.column("key").to_pylist())
        runs = find_runs(words, max((len(t) for t in texts), default=0))
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        out: dict[str, list] = {c: [] for c in ("n_runs", "start", "length", "period", "runs_sha256", "collapsed_sha256", "runs")}
        for i, text in enumerate(texts):
            own = runs[edges[i] : edges[i + 1]] - (starts[i], 0, 0)
            if sources[i] is not None:
                text = [text[j] for j in sources[i].tolist()]
            best = (None, None, None)
            listed = nothing
            if len(own):
                rows = own.tolist()
                best = _strongest(rows)
                listed = hashlib.sha256(b"".join(b"%d,%d,%d\n" % tuple(r) for r in rows)).hexdigest()
                change = np.zeros(len(text) + 1, np.int64)
                np.add.at(change, own[:, 0] + own[:, 2], 1)
                np.add.at(change, own[:, 0] + own[:, 1], -1)
                text = [text[j] for j in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            out["n_runs"].append(len(own))
            for name, value in zip(("start", "length", "period"), best):
                out[name].append(value)
            out["runs_sha256"].append(listed)
            out["collapsed_sha256"].append(hashlib.sha256(b" ".join(text)).hexdigest())
            out["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
        kinds = {c: pa.string() if c.endswith("sha256") else pa.int64() for c in out}
        kinds["runs"] = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        columns = [part.column("id"), *(pa.array(v, kinds[c]) for c, v in out.items())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", *out])


def _strongest(rows: list[list[int]]) -> tuple[int, int, int]:
    """The run with the greatest length by period; of equal ones the first, then that of the smallest period."""
    best = rows[0]
    for row in rows[1:]:
        if row[1] * best[2] > best[1] * row[2]:
            best = row
    return tuple(best)


def text_runs(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``id, n_runs, start, length, period`` of the strongest run, ``runs``, and two digests.

    ``runs`` lists every run in order.  ``collapsed_sha256`` is that of the words
    which are left when of each run only the first period stays.  ``key`` names a
    column of whole numbers: a text whose key ends in 0 gets a period planted first.
    """
    ship(docs.sparkSession)
    number = F.lit(None).cast("bigint") if key is None else F.col(key).cast("bigint")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), number.alias("key"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _summaries,
        f"id {kind}, n_runs bigint, start bigint, length bigint, period bigint, runs_sha256 string, "
        "collapsed_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>",
    )
