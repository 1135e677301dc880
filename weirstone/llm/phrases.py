"""Phrase collocations by set-oriented mining over sorted occurrence relations.

``mine`` counts phrases of up to five words per language.  The occurrences of a
length are a stored relation: one row per chunk, with positions and phrases
sorted by position, a chunk being the texts of one language that a task read
together.  One length follows from the one before:

* the phrases of a chunk are counted in it and dealt to buckets by a hash of the
  phrase; a bucket gets one block from each chunk, adds up the counts and sends
  back to each chunk the places of the phrases that are frequent enough;
* the occurrences of these stay in the relation, all others leave it;
* what is left is merge-joined with itself on adjacent position: two phrases of
  k words that start one word apart are one of k + 1 words.

So each phrase of a chunk is moved once, and only what is frequent moves back.
There are as many buckets as keep each within ``BUCKET_MOST`` phrases of chunks,
whatever the size of the input; no phrase makes a bucket large, as a chunk
holds it once.

A position step of two lies between pieces, so that nothing joins across them.
Frequent phrases are numbered in their bucket, and a phrase of k + 1 words is
the pair of the numbers of its two parts, so equal pairs are equal phrases.
Whole numbers travel as compressed planes of bytes.

Every part of a frequent phrase is frequent itself, so the counts of all parts
come with it: ``heads[i]`` and ``tails[i]`` are those of its first and last i + 1
words.

Cases.  Null text counts as empty and gives nothing; null language is ``und``.
Repeated rows count as often as they are there.  An empty table gives no rows.
Other columns of the documents are not read.  A text is never cut; it may be as
long as a row may be.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.llm.common import bytes_of, ship, slices, stored

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"

# Text bytes of a chunk, or one text.
CHUNK_BYTES = 8 << 20
# Phrases of chunks in a bucket: this many times the root of all, so that blocks do not get ever smaller, within bounds.
BUCKET_ROOT, BUCKET_LEAST, BUCKET_MOST = 64, 1 << 16, 1 << 22
# Numbers of chunks: task, chunk of the task.
_CHUNK_BITS = 32
# Parts in which the first phrases of a language are looked for before the last choice.
_PARTS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_GAP = b"\xff"  # in no UTF-8 text
_MAP = bytes.maketrans(_ENDS + b"\t", _GAP * len(_ENDS) + b" ")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_RELATION = "chunk bigint, lang string, held int, occurrences binary"
# Distinct phrases of a chunk and their counts: words, or numbers of first and last part.
_PHRASES = "listed int, words binary, phrases binary"
_BLOCK = "bucket int, chunk bigint, lang string, words binary, block binary"
_COUNTED = "chunk bigint, known binary, number array<bigint>, a array<bigint>"
_WORD_KEYS, _PAIR_KEYS = "lang array<string>, words array<binary>", "head array<bigint>, tail array<bigint>"
_CODEC = "zstd"


def pieces(text: bytes) -> list[bytes]:
    """Words of a text in lower case, with a gap byte between pieces."""
    return text.translate(_LOWER).translate(_MAP).replace(_GAP, b" \xff ").split()


def _chunk_number(order: int) -> int:
    return TaskContext.get().partitionId() << _CHUNK_BITS | order


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, _CODEC, asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), _CODEC, asbytes=True)


def _packed(*columns: np.ndarray, kind: str = "<i8") -> bytes:
    """Columns of whole numbers, all first bytes of a column together, then all second ones and so on."""
    rows = np.stack(columns).astype(kind)
    planes = rows.view(np.uint8).reshape(*rows.shape, rows.itemsize).transpose(0, 2, 1)
    return _zipped(planes.tobytes())


def _unpacked(data: bytes, columns: int, kind: str = "<i8") -> np.ndarray:
    planes = np.frombuffer(_unzipped(data), np.uint8).reshape(columns, np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind)[..., 0]


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


def _occurrences(at: np.ndarray, place: np.ndarray) -> dict[str, list]:
    """Columns of the occurrences of a chunk: steps between positions, and phrases."""
    return {"held": pa.array([len(at)], pa.int32()), "occurrences": [_packed(_steps(at), place, kind="<i4")]}


def _listed(words: bytes | None, *numbers: np.ndarray) -> dict[str, pa.Array]:
    """Columns of the phrases of a chunk."""
    return {
        "listed": pa.array([len(numbers[0])], pa.int32()),
        "words": pa.array([words], pa.binary()),
        "phrases": pa.array([_packed(*numbers)], pa.binary()),
    }


def _words(limit: int):
    """One row per chunk: the occurrences of its words, and its words with their counts, frequent ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = 0
        for part in (s for batch in batches for s in slices(iter([batch]), "text", limit)):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), bytes_of(part, "text")):
                words = by_lang.setdefault(lang, [])
                words.append(_GAP)
                words += pieces(text)
            for lang, words in by_lang.items():
                coded = pa.array(words, pa.binary()).dictionary_encode()
                # every list of a text begins with the gap, so its code is 0
                codes = coded.indices.to_numpy() - 1
                real = np.flatnonzero(codes >= 0)
                if not len(real):
                    continue
                counts = np.bincount(codes[real])
                by_count = np.argsort(-counts, kind="stable")
                place = np.empty(len(counts), np.int64)
                place[by_count] = np.arange(len(counts))
                listed = coded.dictionary.take(pa.array(by_count + 1)).to_pylist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": [_chunk_number(order)],
                        "lang": [lang],
                        **_occurrences(real, place[codes[real]]),
                        **_listed(_zipped(b" ".join(listed)), counts[by_count]),
                    }
                )
                order += 1

    return run


def _dealt(length: int, buckets: int):
    """The phrases of each chunk as a block per bucket: their places in the chunk, parts and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in (row for batch in batches for row in batch.to_pylist()):
            if length == 1:
                words = _unzipped(chunk["words"]).split(b" ")
                (n,) = _unpacked(chunk["phrases"], 1)
                parts: tuple[np.ndarray, ...] = ()
                mark = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
            else:
                heads, tails, n = _unpacked(chunk["phrases"], 3)
                parts = (np.cumsum(heads), tails)
                mark = parts[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                mark ^= mark >> np.uint64(32)
                mark = (mark + tails.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
                mark ^= mark >> np.uint64(29)
            bucket = (mark % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            rows = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([bucket[r[0]] for r in rows], pa.int32()),
                    "chunk": pa.array([chunk["chunk"]] * len(rows), pa.int64()),
                    "lang": pa.array([chunk["lang"]] * len(rows), pa.string()),
                    "words": pa.array([_zipped(b" ".join([words[i] for i in r])) if length == 1 else None for r in rows], pa.binary()),
                    "block": [_packed(_steps(r), *([_steps(parts[0][r]), parts[1][r]] if parts else []), n[r]) for r in rows],
                }
            )

    return run


def _same_words(rows: list[dict]) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The number of each word of the blocks among the distinct ones, and these."""
    spelled = [f"{r['lang']} ".encode() + w for r in rows for w in _unzipped(r["words"]).split(b" ")]
    coded = pa.array(spelled, pa.large_binary()).dictionary_encode()
    both = [w.rpartition(b" ") for w in coded.dictionary.to_pylist()]
    keys = {"lang": pa.array([w[0].decode() for w in both], pa.string()), "words": pa.array([w[2] for w in both], pa.binary())}
    return coded.indices.to_numpy().astype(np.int64), keys


def _same_pairs(heads: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, dict[str, pa.Array]]:
    order = np.lexsort((tails, heads))
    h, t = heads[order], tails[order]
    new = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return of, {"head": pa.array(h[new]), "tail": pa.array(t[new])}


def _counted(length: int, buckets: int, min_count: int):
    """Frequent phrases of each bucket, and for each chunk the places of its own and their numbers."""

    def count(rows: list[dict]) -> pa.RecordBatch:
        blocks = [_unpacked(r["block"], 2 if length == 1 else 4) for r in rows]
        of, keys = (
            _same_words(rows)
            if length == 1
            else _same_pairs(np.concatenate([np.cumsum(b[1]) for b in blocks]), np.concatenate([b[2] for b in blocks]))
        )
        total = np.zeros(int(of.max()) + 1, np.int64)
        np.add.at(total, of, np.concatenate([b[-1] for b in blocks]))
        frequent = total >= min_count
        number = np.where(frequent, (np.cumsum(frequent) - 1) * buckets + rows[0]["bucket"], -1)
        chunks, known, start = [], [], 0
        for row, block in zip(rows, blocks, strict=True):
            mine = number[of[start : start + block.shape[1]]]
            start += block.shape[1]
            kept = mine >= 0
            if kept.any():
                chunks.append(row["chunk"])
                known.append(_packed(_steps(np.cumsum(block[0])[kept]), mine[kept]))
        mask, none = pa.array(frequent), [None] * len(chunks)
        lists = {"number": pa.array(number), "a": pa.array(total), **keys}
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([None, *chunks], pa.int64()),
                "known": pa.array([None, *known], pa.binary()),
                **{k: pa.array([v.filter(mask).to_pylist(), *none], pa.list_(v.type)) for k, v in lists.items()},
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for row in (row for batch in batches for row in batch.to_pylist()):
            if rows and row["bucket"] != rows[0]["bucket"]:
                yield count(rows)
                rows = []
            rows.append(row)
        if rows:
            yield count(rows)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep frequent phrases of each chunk, and join those one position apart to longer ones."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            steps, place = _unpacked(row.column("occurrences")[0].as_py(), 2, "<i4")
            at = np.cumsum(steps, dtype=np.int64)
            known = [_unpacked(b, 2) for b in row.column("known")[0].as_py()]
            places, number = np.concatenate([np.cumsum(b[0]) for b in known]), np.concatenate([b[1] for b in known])
            by_number = np.argsort(number)
            number = number[by_number]
            local = np.full(int(place.max()) + 1, -1, np.int64)
            local[places[by_number]] = np.arange(len(number))
            mine = local[place]
            frequent = mine >= 0
            at, mine = at[frequent], mine[frequent]
            near = at[1:] == at[:-1] + 1
            if not near.any():
                continue
            pairs, place, counts = np.unique(
                mine[:-1][near] * len(number) + mine[1:][near], return_inverse=True, return_counts=True
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": row.column("chunk"),
                    "lang": row.column("lang"),
                    **_occurrences(at[:-1][near], place),
                    **_listed(None, _steps(number[pairs // len(number)]), number[pairs % len(number)], counts),
                }
            )


def _buckets(found: DataFrame) -> int:
    listed = found.agg(F.sum("listed")).first()[0] or 0
    return max(1, math.ceil(listed / min(BUCKET_MOST, max(BUCKET_LEAST, BUCKET_ROOT * math.isqrt(listed)))))


def _count(found: DataFrame, length: int, min_count: int) -> DataFrame:
    """Rows without a chunk: the frequent phrases of a bucket.  With one: places of frequent phrases in it, and numbers."""
    buckets = _buckets(found)
    blocks = found.select("chunk", "lang", "words", "phrases").mapInArrow(_dealt(length, buckets), _BLOCK)
    by_bucket = blocks.repartition("bucket").sortWithinPartitions("bucket")
    keys = _WORD_KEYS if length == 1 else _PAIR_KEYS
    return by_bucket.mapInArrow(_counted(length, buckets, min_count), f"{_COUNTED}, {keys}")


def _columns(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def mine(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    text_col: str = "text",
    lang_col: str = "lang",
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1, 2, ... words, a table for each length, and the words of each language.

    A phrase has ``number, lang, phrase, last`` (its last word)``, a, heads, tails`` and,
    from two words on, the numbers ``head`` and ``tail`` of its first and last
    words but one.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    found = stored(rows.mapInArrow(_words(CHUNK_BYTES), f"{_RELATION}, {_PHRASES}"), "words")
    n_words = found.groupBy("lang").agg(F.sum("held").alias("n"))
    tables = []
    for length in range(1, longest + 1):
        keys = ["lang", "words"] if length == 1 else ["head", "tail"]
        counted = stored(_count(found, length, min_count), f"counted-{length}")
        lists = F.explode(F.arrays_zip("number", "a", *keys)).alias("p")
        frequent = counted.where("chunk IS NULL").select(lists).select("p.*")
        tables.append(stored(_described(frequent, tables), f"phrases-{length}"))
        if length < longest:
            known = counted.where("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list("known").alias("known"))
            grown = found.select(*_columns(_RELATION)).join(known, "chunk").mapInArrow(_joined, f"{_RELATION}, {_PHRASES}")
            found = stored(grown, f"occurrences-{length + 1}")
    return tables, n_words


def _described(frequent: DataFrame, shorter: list[DataFrame]) -> DataFrame:
    """Text and part counts of phrases, from the phrases that are one word shorter."""
    if not shorter:
        word = F.col("words").cast("string")
        return frequent.select(
            "number", "lang", word.alias("phrase"), word.alias("last"), "a",
            F.array("a").alias("heads"), F.array("a").alias("tails"),
            F.lit(None).cast("bigint").alias("head"), F.lit(None).cast("bigint").alias("tail"),
        )
    first = shorter[-1].select(
        F.col("number").alias("head"), F.col("lang").alias("_lang"), F.col("phrase").alias("_p"), F.col("heads").alias("_h")
    )
    second = shorter[-1].select(F.col("number").alias("tail"), "last", F.col("tails").alias("_t"))
    rows = frequent.join(first, "head").join(second, "tail")
    return rows.select(
        "number", "_lang", F.concat_ws(" ", "_p", "last").alias("phrase"), "last", "a",
        F.concat("_h", F.array("a")).alias("heads"), F.concat("_t", F.array("a")).alias("tails"), "head", "tail",
    ).withColumnRenamed("_lang", "lang")


def _lowest_cut(length: int) -> Column:
    """The cut of a phrase with the lowest score; of equal scores the first."""
    wide = "decimal(20,0)"

    def cut(k: int) -> Column:
        left, right = F.col("heads")[k - 1], F.col("tails")[length - k - 1]
        product = f"CAST(a AS {wide}) * 1000BD * CAST(n AS DECIMAL(18,0))"
        parts = f"CAST(heads[{k - 1}] AS {wide}) * CAST(tails[{length - k - 1}] AS DECIMAL(18,0))"
        score = F.expr(f"({product}) div ({parts})")
        return F.struct(score.cast("bigint").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*[cut(k) for k in range(1, length)]))


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is left out if a longer one that holds it occurs as often.  It
    is enough to look one word further: between the two lies a phrase of every
    length, and none of these occurs less often than the longer one.
    """
    tables, n_words = mine(docs, min_count, longest, text_col, lang_col)
    kept = []
    for place, phrases in enumerate(tables[1:], 1):
        rows = phrases
        if place + 1 < len(tables):
            longer = tables[place + 1]
            most = longer.select(F.col("head").alias("number"), "a").unionByName(
                longer.select(F.col("tail").alias("number"), "a")
            )
            most = most.groupBy("number").agg(F.max("a").alias("_most"))
            rows = rows.join(most, "number", "left").where(F.col("_most").isNull() | (F.col("_most") < F.col("a")))
        scored = rows.join(n_words, "lang").withColumn("_cut", _lowest_cut(place + 1))
        kept.append(scored.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score", "number"))
    every = kept[0]
    for rows in kept[1:]:
        every = every.unionByName(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("number"), F.lit(_PARTS))
    some = every.withColumn("_place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    first = some.where(F.col("_place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = first.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
