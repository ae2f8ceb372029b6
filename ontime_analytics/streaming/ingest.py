"""S4 as an incremental file stream: new yearly files -> typed lake.

The batch ingest (:mod:`ontime_analytics.sources.ingest`) re-reads a whole
folder.  When yearly (or monthly) files keep arriving, Structured Streaming's
file source picks up only files it has not seen; the checkpoint records them,
so a restarted or failed run neither loses nor duplicates a file, and the
Parquet sink commits each micro-batch atomically.  ``availableNow`` processes
everything present and stops, which suits a scheduled job.

The stream needs a lake folder of its own: its metadata log hides files it did
not write.  :func:`ontime_analytics.sources.flights.read_flights` reads that
lake and one of batch loads together.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ontime_analytics.session import has_shared_folder, streaming_checkpoint
from ontime_analytics.sources.flights import LOAD_COLUMN, parse_flight_lines, type_flights
from ontime_analytics.sources.ingest import has_batch_files, load_key


def default_checkpoint(spark: SparkSession, source_dir: str, lake: str) -> str:
    """A checkpoint folder for this source and this lake under the shared folder.

    Without a configured shared folder it would be another one in every
    session, and each run would load all files again: an explicit location is
    asked for instead."""
    if not has_shared_folder(spark):
        raise ValueError("spark.checkpoint.dir is not set: name a checkpoint_location")
    pair = "\n".join(x.rstrip("/") for x in (source_dir, lake))
    return streaming_checkpoint(spark, "flight_ingest-" + hashlib.sha256(pair.encode()).hexdigest()[:16])


def start_flight_ingest(spark: SparkSession, source_dir: str, lake: str,
                        checkpoint_location: str | None = None, header: bool = True,
                        available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream new files of ``source_dir`` into ``lake`` (partitioned by year and load)."""
    if has_batch_files(spark, lake):
        raise ValueError(f"{lake} holds batch loads; stream into a folder of its own and read both")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir).select("value", load_key(F.input_file_name()).alias(LOAD_COLUMN))
    typed = type_flights(parse_flight_lines(lines, header=header, keep=(LOAD_COLUMN,)), keep=(LOAD_COLUMN,))
    writer = (typed.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_location or default_checkpoint(spark, source_dir, lake))
              .partitionBy("year", LOAD_COLUMN)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(lake)
