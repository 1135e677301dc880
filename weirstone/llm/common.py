"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.session import materialise

# A word: code points other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
# Text bytes that a Python task works on at a time.
SLICE_BYTES = 4 << 20
# Seconds until Spark has heard of dropped handles.
HANDLES_WAIT = 0.2


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="weirstone-"), "weirstone_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder in (top, os.path.join(top, "llm")):
            for name in sorted(os.listdir(folder)):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; what led to it can then be forgotten.

    The collection lets Spark drop shuffle files that only the finished job
    used, so a chain of steps holds the disk of one step, not of all.  The
    handles that Python drops reach Spark by a thread of their own, and what
    they led to is unreachable only after a first collection, hence two with a
    short wait before each.
    """
    out = materialise(df, f"llm-{label}")
    del df
    gc.collect()
    for _ in range(2):
        time.sleep(HANDLES_WAIT)
        out.sparkSession.sparkContext._jvm.System.gc()
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [v or b"" for v in batch.column(column).cast(pa.binary()).to_pylist()]


def with_company(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of rows sorted by a column of whole numbers, with a mask of rows whose value another row has.

    Equal values are neighbours, so one row is held back from batch to batch.
    """
    held, before = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*([held] if held else []), batch]).combine_chunks().to_batches()[0]
        values = rows.column(column).to_numpy()
        same = values[1:] == values[:-1]
        mask = np.append(same, False)
        mask[1:] |= same
        mask[0] |= before is not None and values[0] == before
        last = len(values) - 1
        if last:
            yield rows.slice(0, last), mask[:last]
            before = values[last - 1]
        held = rows.slice(last)
    if held is not None:
        yield held, np.array([before is not None and held.column(column)[0].as_py() == before])
