"""Incremental ingestion of raw feeds into bronze with Structured Streaming.

Bronze is row-wise, so the same ``DataFrame -> DataFrame`` functions run on a
stream.  Files are picked up as they land; the checkpoint records which files
were taken, so each file is ingested once even across restarts.  Run with
``available_now=True`` for a scheduled catch-up (process everything new,
then stop) or without it for a continuously running ingest.

* JSON lines: a file-source stream typed and flagged in flight, written by
  the file sink (its commit log makes the output exactly-once).
* CSV: headers may differ from file to file, and a stream's CSV source binds
  columns by position.  So the stream only *lists* new files (``binaryFile``
  with just the path selected: contents are never read), and each
  micro-batch reads its files with the by-name batch reader.  A micro-batch
  overwrites its own folder, ``ingest=<checkpoint>/batch_id=<n>``, so a retried
  batch replaces its earlier attempt instead of duplicating it, and an ingest
  with another checkpoint, which counts its batches from 0, touches no other's.

Every file below the feed's path is taken, as by the batch readers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratum.functions.casts import string_schema, type_strings
from stratum.sources import feeds
from stratum.sources.tables import DEFAULT_FORMAT, write_table

ToBronze = Callable[[DataFrame], DataFrame]

# the binaryFile source's fixed schema (a stream must declare it)
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def json_to_bronze(spark: SparkSession, feed_path: str, schema: T.StructType, to_bronze: ToBronze,
                   table_path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT,
                   max_files_per_trigger: int | None = None, available_now: bool = True,
                   interval: str = "1 minute") -> StreamingQuery:
    reader = (spark.readStream.schema(string_schema(schema.fieldNames(), feeds.CORRUPT))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", feeds.CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(feed_path).select("*", F.col("_metadata.file_path").alias(feeds.SOURCE))
    # malformed text stays in the table, where :func:`stratum.sources.feeds.quarantine` finds it
    typed = type_strings(raw, schema, keep=(feeds.SOURCE, feeds.CORRUPT), failed=feeds.BAD)
    writer = (to_bronze(typed).writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now, interval).start(table_path)


def csv_to_bronze(spark: SparkSession, feed_path: str, schema: T.StructType, to_bronze: ToBronze,
                  table_path: str, checkpoint: str, fmt: str = DEFAULT_FORMAT,
                  max_files_per_trigger: int = 1000, available_now: bool = True,
                  interval: str = "1 minute", required: Sequence[str] = ()) -> StreamingQuery:
    """A file whose header lacks a ``required`` column fails its micro-batch, and with it the query, before any of the
    batch's rows are written; the batch is taken up again once the file is mended or gone."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    # bounds the file names one micro-batch hands to the driver
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(feed_path).select("path")
    ingest_id = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def ingest(batch: DataFrame, batch_id: int) -> None:
        # as many paths as files in this micro-batch (bounded by maxFilesPerTrigger)
        paths = sorted(feeds.literal_path(r["path"]) for r in batch.collect())
        if not paths:
            return
        feed = feeds.read_csv_feed(batch.sparkSession, paths, schema, required=required)
        write_table(to_bronze(feed), f"{table_path}/ingest={ingest_id}/batch_id={batch_id}", fmt)

    writer = files.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def run_to_completion(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query; re-raise its failure if it had one."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
