"""Resumable ingestion of landed files.

Each run takes what is there and stops.  The checkpoint names the files already
taken, so a restart goes on where the last run ended and writes nothing twice.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from weirstone.operators.keyed import first_per_key, pending

# Seconds to wait for the events of a run that has ended.
EVENT_WAIT = 60
# Column and number of the folders of a table that is looked up by key.
BUCKET, BUCKETS = "key_bucket", 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files at a path."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


class _Rows(StreamingQueryListener):
    """Adds up the input rows of every batch of one run; the progress a query keeps is cut to its last batches."""

    def __init__(self) -> None:
        self.by_run: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.by_run.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        self.by_run[run] = self.by_run.get(run, 0) + int(event.progress.numInputRows)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.runId))


def _run(writer: DataStreamWriter, spark: SparkSession) -> int:
    """Start a run and wait for its end; the number of input rows it took."""
    rows = _Rows()
    spark.streams.addListener(rows)
    try:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        run, waited = str(query.runId), time.monotonic()
        while run not in rows.ended:  # events come in order, the end last
            if time.monotonic() - waited > EVENT_WAIT:
                raise RuntimeError("the end of the run was not reported")
            time.sleep(0.02)
        return rows.by_run.get(run, 0)
    finally:
        spark.streams.removeListener(rows)


def run_append(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append what is new to a table and stop; each input file is taken once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _run(writer, stream.sparkSession)


def key_bucket(keys: Sequence[str], buckets: int, schema: T.StructType) -> Column:
    """Bucket of a row by its key; keys that are equal have one bucket."""
    floats = {f.name for f in schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    parts = [F.col(k) + F.lit(0.0) if k in floats else F.col(k) for k in keys]  # makes -0.0 and 0.0 alike
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def stored_rows(spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of a bucketed table; given buckets prune the scan to their folders."""
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    rows = spark.read.schema(full).parquet(path)
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin([int(b) for b in buckets]))
    return rows.select(*schema.names)


def run_insert_ignore(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS
) -> int:
    """Append rows with new keys only: stored rows are never touched.

    The table lies in folders by bucket of the key, and a batch reads only the
    buckets that its own keys have: a batch of few keys costs what it holds,
    however large the table is.  ``buckets`` must stay the same for a table.
    Within a batch the first row of a key in ``order`` is kept.  A batch that is
    repeated after a failure finds its own keys stored and adds nothing.
    """
    schema = stream.schema
    bucket = key_bucket(keys, buckets, schema)

    def write(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        first = first_per_key(batch, keys, order).withColumn(BUCKET, bucket).persist()
        try:
            touched = [r[0] for r in first.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            try:
                stored = stored_rows(spark, path, schema, touched)
                stored.isEmpty()
                fresh = pending(first, stored, keys)
            except Exception as error:  # the table is not there before the first batch
                if "PATH_NOT_FOUND" not in str(error):
                    raise
                fresh = first
            fresh.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
        finally:
            first.unpersist()

    return _run(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), stream.sparkSession)


def run_complete_groups(
    landed_rows: DataFrame, expected: DataFrame, path: str, checkpoint: str, parent: str, child: Sequence[str]
) -> int:
    """Append each parent once, when the last of its expected children has landed.

    ``expected`` is a table of (parent, child): children that are not in it do
    not count, and a child counts once however often it lands.  It is read anew in each batch.
    The children seen are a table below the checkpoint, one folder per batch,
    so a parent may fill up over any number of runs.  A batch is two jobs of plain
    aggregates: what it has that was not seen is stored, then expected and seen
    children are counted together by parent.  A batch that is repeated leaves its own
    folders out and replaces them.  Rows are ``parent, n_expected, n_stored``.
    """
    pair = [parent, *child]
    children = landed_rows.select(*pair)
    folder = f"{checkpoint}/seen"
    full_schema = T.StructType([*children.schema.fields, T.StructField("batch", T.LongType())])

    def seen(spark: SparkSession, batches: Column) -> DataFrame:
        return spark.read.schema(full_schema).parquet(folder).where(batches)

    def write(batch: DataFrame, batch_id: int) -> None:
        before = seen(batch.sparkSession, F.col("batch") < batch_id).select(*pair, F.lit(True).alias("_old"))
        both = before.unionByName(batch.dropna(subset=pair).select(*pair, F.lit(False).alias("_old")))
        fresh = both.groupBy(*pair).agg(F.max("_old").alias("_old")).where("NOT _old").select(*pair)
        fresh.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        yes, no = F.lit(True), F.lit(False)
        wanted = expected.where(F.col(parent).isNotNull()).select(*pair, yes.alias("_due"), no.alias("_here"), no.alias("_new"))
        landed_ = seen(expected.sparkSession, F.col("batch") <= batch_id).select(
            *pair, no.alias("_due"), yes.alias("_here"), (F.col("batch") == batch_id).alias("_new")
        )
        marks = [F.max(c).alias(c) for c in ("_due", "_here", "_new")]
        each = wanted.unionByName(landed_).groupBy(*pair).agg(*marks).where("_due")
        counts = each.groupBy(parent).agg(
            F.count(F.lit(1)).alias("n_expected"), F.count_if("_here").alias("n_stored"), F.max("_new").alias("_new")
        )
        done = counts.where("_new AND n_stored = n_expected").select(parent, "n_expected", "n_stored")
        # a batch that is repeated replaces its own folder
        done.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    spark = landed_rows.sparkSession
    # an empty folder before the first batch, so that there always is something to read
    spark.createDataFrame([], children.schema).write.mode("ignore").parquet(f"{folder}/batch=-1")
    return _run(children.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), spark)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of the runs started inside lies on disk."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def run_dedupe(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], event_time: str | None = None, delay: str | None = None
) -> int:
    """Append each key once over all runs.

    Without a delay every key ever seen stays in state (RocksDB keeps it on
    disk), so a repeat is found however late it comes.  With ``event_time`` and
    ``delay`` the state is bounded: repeats are found within the delay.
    """
    if delay is None:
        once = stream.dropDuplicates(list(keys))
    else:
        once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    with _rocksdb(stream.sparkSession):
        return run_append(once, path, checkpoint)
