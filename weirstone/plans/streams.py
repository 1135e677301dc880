"""Resumable ingestion of the events table."""

from __future__ import annotations

from weirstone.plans.registry import query, table
from weirstone.session import fresh_path
from weirstone.streaming import ingest

_EVENTS = "SELECT event_id, user_id, event_type FROM events"
_COLUMNS = ("event_id", "user_id", "event_type")


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # A pattern, so that the table may be one file or a folder of files.
    return ingest.landed(spark, f"{sf}/event[s].parquet", schema)


@query("resumable_ingest", _EVENTS)
def resumable_ingest(spark, sf):
    path, checkpoint = fresh_path(spark, "ingested"), fresh_path(spark, "ingest-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest.run_append(_stream(spark, sf).select(*_COLUMNS), path, checkpoint)
    return spark.read.parquet(path).select(*_COLUMNS)


@query("stream_dedupe", _EVENTS)
def stream_dedupe(spark, sf):
    path, checkpoint = fresh_path(spark, "deduped"), fresh_path(spark, "dedupe-checkpoint")
    repeated = _stream(spark, sf).union(_stream(spark, sf)).select(*_COLUMNS)
    ingest.run_dedupe(repeated, path, checkpoint, ["event_id"])
    return spark.read.parquet(path).select(*_COLUMNS)


@query(
    "stream_insert_ignore",
    "SELECT user_id, MIN(event_id) AS event_id FROM events GROUP BY user_id",
)
def stream_insert_ignore(spark, sf):
    path = fresh_path(spark, "first-events")
    rows = _stream(spark, sf).select("user_id", "event_id")
    for _ in range(2):  # a lost checkpoint: the batch comes again and must add nothing
        ingest.run_insert_ignore(rows, path, fresh_path(spark, "first-checkpoint"), ["user_id"], ["event_id"], buckets=16)
    return ingest.stored_rows(spark, path, rows.schema)


@query(
    "stream_complete_groups",
    """SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS n_expected, COUNT(DISTINCT l_linenumber) AS n_stored
       FROM lineitem GROUP BY l_orderkey HAVING MAX(l_linenumber) <= 5""",
)
def stream_complete_groups(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    folder, path, checkpoint = (fresh_path(spark, n) for n in ("landed-lines", "complete", "complete-checkpoint"))
    # lines land in three runs, some of them twice; the sixth and later ones of an order never do
    for part in ("l_linenumber <= 2", "l_linenumber IN (2, 3)", "l_linenumber BETWEEN 4 AND 5"):
        lines.where(part).write.mode("append").parquet(folder)
        stream = ingest.landed(spark, folder, lines.schema)
        ingest.run_complete_groups(stream, lines, path, checkpoint, "l_orderkey", ["l_linenumber"])
    schema = "l_orderkey bigint, n_expected bigint, n_stored bigint"
    return spark.read.schema(schema).parquet(path).select("l_orderkey", "n_expected", "n_stored")
