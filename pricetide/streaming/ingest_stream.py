"""Structured Streaming pick-up of new and rewritten price files.

The stream carries the *listing* of files (path and time, no content); every
micro-batch hands it to the batch job, so both read files, choose versions,
commit in rounds and treat bad lines in one way. The listing comes from
:mod:`pricetide.streaming.listing_source`, which sees a file rewritten under its own
path; with ``max_files_per_trigger`` it comes from Spark's file source instead, which
bounds a batch but takes every path once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricetide.plans.ingest import IngestOptions, ingest_listing
from pricetide.sources.file_keys import listed, listing_options
from pricetide.streaming.listing_source import listing_stream

# A hundred years; the columns of a file listing.
MAX_FILE_AGE = "36500d"
LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of (path, modificationTime) of files under new paths; contents
    stay unread."""
    # The source would ignore files older than a week before the newest: here
    # versions decide, so a file of another key may be of any age.
    opts = listing_options() | {"maxFileAge": MAX_FILE_AGE}
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    return (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).options(**opts).load(source)
                 .select("path", "modificationTime"))


def start_ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                        options: IngestOptions | None = None, available_now: bool = True,
                        processing_time: str | None = None, max_files_per_trigger: int | None = None,
                        late_seconds: float | None = None) -> StreamingQuery:
    """Stream every new or rewritten file under ``source`` into the versioned
    table at ``target``. ``available_now`` processes what is there and stops (the
    per-event job of a scheduler); otherwise runs every ``processing_time``.
    A batch that is replayed after a failure meets its files on record or
    writes them again, to the same end."""
    options = options or IngestOptions()

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        ingest_listing(batch.sparkSession, listed(batch), target, options, new_only=True)

    files = (file_stream(spark, source, max_files_per_trigger) if max_files_per_trigger
             else listing_stream(spark, source, late_seconds))
    writer = files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available_now(spark: SparkSession, source: str, target: str, checkpoint: str,
                      options: IngestOptions | None = None) -> None:
    query = start_ingest_stream(spark, source, target, checkpoint, options, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
