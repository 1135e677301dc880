"""Byte-level BPE: texts to token ids by a rank file, and ids back to bytes.

The tiktoken library does the merges.  Each Python worker builds its encoder
once from the rank file, which the driver reads (a vocabulary of fixed size,
checked against ``MAX_RANK_BYTES``) and broadcasts.

Long texts are cut before they reach the library.  Every alternative of the
pre-splitting pattern takes white space only in front of other characters, so
no match runs from another character into white space: the place between a
character and the white space after it is always a boundary of matches, and
cutting there changes no id.  A long run of white space would overflow the
pattern engine's stack; it is one match, but for its last character where more
text follows, and goes to the merges as such.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows give the same ids; null ids pass through; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.llm.common import ship, slices

MAX_RANK_BYTES = 64 << 20
# Texts above this many characters are cut at safe boundaries.
PIECE_CHARS = 1 << 16
LONG_RUN = 1000
# White_Space of Unicode, which the pattern engine's \s stands for: fixed values.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_WHITE = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
_BOUNDARY = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")

_encoders: dict = {}


def read_ranks(path: str) -> bytes:
    size = os.path.getsize(path)
    if size > MAX_RANK_BYTES:
        raise ValueError(f"rank file of {size} bytes; the bound is {MAX_RANK_BYTES}")
    with open(path, "rb") as file:
        return file.read()


def encoder(ranks: bytes, pattern: str):
    """The tiktoken encoder of a rank file's content, one per process."""
    key = (hash(ranks), pattern)
    if key not in _encoders:
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries into pieces of about ``size`` characters; they join to the text."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc, text: str) -> list[int]:
    if len(text) <= LONG_RUN:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in _LONG_WHITE.finditer(text):
        if run.start() < start:  # starts with the character left over from the run before
            continue
        end = run.end() - (run.end() < len(text))
        for piece in pieces(text[start : run.start()]):
            ids += enc.encode_ordinary(piece)
        ids += enc._core_bpe.encode_single_piece(text[run.start() : end].encode())
        start = end
    for piece in pieces(text[start:]):
        ids += enc.encode_ordinary(piece)
    return ids


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: ``id_col``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches):
        enc = encoder(shared.value, pattern)
        for part in slices(batches, "_text"):
            packed, counts = [], []
            for text in part.column("_text").to_pylist():
                ids = np.array(encode_text(enc, text or ""), dtype="<u4")
                packed.append(ids.tobytes())
                counts.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                names=[id_col, "n_tokens", "ids"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the raw bytes of the ids, which need not be valid UTF-8 where ids were cut."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches):
        enc = encoder(shared.value, pattern)
        for part in slices(batches, ids_col):
            out = [
                None if ids is None else enc.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())
                for ids in part.column(ids_col).to_pylist()
            ]
            names = [n for n in part.schema.names if n != "decoded"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array(out, pa.binary())], names=[*names, "decoded"]
            )

    kept = encoded.drop("decoded")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{kinds}, decoded binary")
