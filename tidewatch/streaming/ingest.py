"""Structured Streaming jobs.

T1 ``ingest_landing_stream``: new landing files only, resumable from the
checkpoint. Pages are read as text and parsed with ``from_json`` against the
item schema (as in batch), so a broken page cannot stop the stream; it is
routed to a quarantine folder.

T2 ``stream_upsert``: ``foreachBatch`` merge of each micro-batch into a
bucketed table. A stream is known by its checkpoint folder; the table's version
remembers the newest batch of each stream, so replaying a batch after a failure
does nothing, and a stream with a new checkpoint starts afresh.

Items are ordered by file, place in the file and place in the page, so of
repeated keys the last one wins as if rows were applied one by one. Items
without an id are kept, as in batch; only an empty page has no items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..operators import merge as MG
from ..session import scratch_path
from ..sources.landing import ITEM_ORDER, numbered_files, parse_pages, split_corrupt


def stream_id(checkpoint: str) -> str:
    """Name of the stream that keeps its progress in ``checkpoint``."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of landing pages: a line of text each, with its file and place."""
    r = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path).select("value", F.col("_metadata.file_path").alias("_source_file"),
                               F.col("_metadata.file_block_start").alias("_block"))


def _items(batch: DataFrame, item_schema: T.StructType) -> DataFrame:
    """Items of a micro-batch, parsed once and written, so that the good rows, the
    corrupt files and the quarantine read one result."""
    path = scratch_path(batch.sparkSession, "stream-batch")
    parse_pages(batch, item_schema).write.parquet(path)
    return batch.sparkSession.read.parquet(path)


SPLIT_MB = 16   # of a merge's input per task: some hundred thousand items, whose sort stays in memory


def _sized_for_merge(session: SparkSession) -> None:
    """Settings of the stream's own session: smaller splits, and a writer for every
    bucket in place of a sort by bucket, so that a merge's tasks do not spill."""
    most = "spark.sql.files.maxPartitionBytes"
    session.conf.set(most, str(min(SPLIT_MB << 20, session._jsparkSession.sessionState().conf().filesMaxPartitionBytes())))
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(MG.BUCKETS))


def ingest_landing_stream(spark: SparkSession, path: str, item_schema: T.StructType,
                          flatten: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                          quarantine_path: str | None = None, available_now: bool = True):
    """Flattened rows of new files under ``out_path/stream=<id>/batch_id=<n>``
    (parquet, replay-safe); corrupt pages go to ``quarantine_path``. Returns
    the started query."""
    pages, sid = landing_stream(spark, path), stream_id(checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One directory per stream and micro-batch, overwritten on replay: a batch
        # re-run after a failure between write and commit does not duplicate rows.
        # A file is never split across micro-batches, so the batch rule of S3
        # (skip a file with any unreadable page) applies per micro-batch.
        good, bad = split_corrupt(_items(batch, item_schema))
        flatten(good).write.mode("overwrite").parquet(f"{out_path}/stream={sid}/batch_id={batch_id}")
        if quarantine_path:
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/stream={sid}/batch_id={batch_id}")

    w = pages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_upsert(spark: SparkSession, path: str, item_schema: T.StructType,
                  flatten: Callable[[DataFrame], DataFrame], table_path: str, checkpoint: str,
                  keys: Sequence[str], update_cols: Sequence[str] | None = None, available_now: bool = True):
    """Keyed merge per micro-batch into a Parquet table; of repeated keys in a
    batch the last item wins. A batch that is replayed merges to the same rows."""
    pages = landing_stream(spark, path)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        _sized_for_merge(batch.sparkSession)
        items = _items(batch, item_schema)
        good, _ = split_corrupt(items)
        rows = flatten(numbered_files(good, items), ITEM_ORDER)
        MG.merge_into(batch.sparkSession, table_path, rows, keys, update_cols=update_cols, seq_col=ITEM_ORDER)

    w = pages.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
