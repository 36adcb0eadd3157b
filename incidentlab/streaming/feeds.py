"""Monthly feeds arrive as new CSV files in new month folders.  The file
stream source picks up only files it has not seen (tracked in the checkpoint),
applies the same normalisation and typing as the batch ingest, and appends to
the partitioned Parquet table with exactly-once file-sink semantics.  Run it
on a schedule with ``availableNow`` (process what is there, then stop) or as a
continuous query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from incidentlab.operators.columns import normalize_columns, type_month_feed, type_timestamp_feed
from incidentlab.schemas import FEEDS


def feed_stream(spark: SparkSession, feed: str, path_glob: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of one raw feed, typed like the batch ingest."""
    schema, _ = FEEDS[feed]
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = normalize_columns(reader.csv(path_glob))
    return type_timestamp_feed(df) if feed == "stop_and_search" else type_month_feed(df)


def ingest_new_files(
    spark: SparkSession,
    feed: str,
    path_glob: str,
    out_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
) -> StreamingQuery:
    """Append newly arrived files of ``feed`` to ``out_path`` (Parquet by
    year/month).  ``checkpoint_path`` must be on shared storage; a restarted
    query resumes from it after an executor or driver loss.

    Give the stream a folder of its own: the file sink keeps a log of its files
    there, and readers ignore files that a batch job adds beside them."""
    writer = (
        feed_stream(spark, feed, path_glob)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("year", "month")
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start(out_path)
