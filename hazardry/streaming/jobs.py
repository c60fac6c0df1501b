"""Streaming jobs.  Each is its own query with its own checkpoint, and so its own
offsets: every consumer sees all events.

Offsets move only after a batch is written; a failing batch is retried, and all
sinks here take a repeated batch without harm.  ``trigger`` is passed through to
the writer; ``availableNow=True`` drains the source and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardry import constants as C
from hazardry.operators import processing
from hazardry.operators.documents import to_document
from hazardry.sources import docstore
from hazardry.sources.readers import parse_messages
from hazardry.sources.sinks import topic_messages
from hazardry.sources.workspace import remove


def ingest(messages: DataFrame) -> DataFrame:
    """Message values (Kafka or files) to unified events."""
    return parse_messages(messages)


def process(
    events: DataFrame, profile: str = "fmi", below_min: str = "low", processed_at: Column | None = None
) -> DataFrame:
    """Validate, classify and enrich; stateless, one event at a time."""
    return processing.process_events(events, profile, below_min, processed_at)


def append_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, **trigger
) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def upsert_documents(
    processed: DataFrame, path: str, checkpoint: str, order: list[str], **trigger
) -> StreamingQuery:
    """Upsert processed events into the documents at ``path``, last write per id wins.

    A batch rewrites the folders it touches (see :mod:`hazardry.sources.docstore`).
    """
    schema = to_document(processed).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        docstore.write_batch(to_document(batch), path, schema, order)

    return (
        processed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def route_by_type(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Messages to one folder per topic."""
    return append_files(topic_messages(events), path, checkpoint, ["topic"], **trigger)


def publish_to_kafka(events: DataFrame, servers: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Messages to the topics of a Kafka cluster; needs the Kafka connector on the class path."""
    return (
        topic_messages(events)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _write_version(rows: DataFrame, path: str, version: int) -> None:
    """Write a version whole; the one before stays for a retry and for readers, the one before that goes."""
    rows.write.mode("overwrite").parquet(f"{path}/version={version}")
    if version > 1:
        remove(rows.sparkSession, f"{path}/version={version - 2}")


def _latest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    stored = spark.read.schema(f"{schema}, version long").parquet(path)
    return stored.filter(F.col("version") == stored.agg(F.max("version")).scalar()).drop("version")


def running_counts(
    processed: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Counters by type and level.  Every batch is a version of its own, so a reader
    (:func:`read_counts`) or a crash never meets a half-written one."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        _write_version(batch, path, batch_id)

    return (
        processing.running_counts(processed)
        .writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of :func:`running_counts`."""
    return _latest(spark, path, "event_type string, severity_level string, event_count long")


def running_stats(
    events: DataFrame, path: str, checkpoint: str, profile: str = "fmi", below_min: str = "drop", **trigger
) -> StreamingQuery:
    """Processing statistics of everything a stream has received so far.

    A batch's row of counts is added to that of the version before, which a
    version names by its batch, so a batch that is run again gives the same row
    and a restart goes on where the last one ended.
    """
    names = processing.outcome_counts(events, profile, below_min).columns

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = processing.outcome_counts(batch, profile, below_min)
        if batch_id:
            counts = counts.unionByName(batch.sparkSession.read.schema(counts.schema).parquet(f"{path}/version={batch_id - 1}"))
        _write_version(counts.agg(*[F.sum(F.col(f"`{n}`")).alias(n) for n in names]), path, batch_id)

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """``measure``, ``value`` of the latest version of :func:`running_stats`, as ``processing.processing_report`` gives them."""
    counts = ["received", "processed", "dropped_invalid", "dropped_below_threshold"]
    counts += [f"type:{t}" for t in C.EVENT_TYPES] + [f"level:{v}" for v in C.SEVERITY_LEVELS]
    return processing.report_of(_latest(spark, path, ", ".join(f"`{n}` long" for n in counts)))


def critical_alerts(processed: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    return append_files(processing.critical(processed), path, checkpoint, **trigger)


def live_events(events: DataFrame, hours: int = C.LIVE_WINDOW_HOURS) -> DataFrame:
    """The live feed without repeats: one row per event id inside the window.

    For the live feed only.  The watermark forgets ids after ``hours`` and drops
    rows that come later than that, so a replay of history must not pass here;
    the durable store takes the stream before this step.  What is dropped is
    counted: :func:`late_rows`.
    """
    return events.withWatermark("event_time", f"{hours} hours").dropDuplicatesWithinWatermark(
        ["event_id"]
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped as later than its watermark, over the progress it still remembers."""
    return sum(
        op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators
    )


def new_events(stored: DataFrame, cursor: str) -> DataFrame:
    """Events of a growing table that were processed after the cursor."""
    return stored.filter(F.col("processed_at") > F.lit(cursor).cast("timestamp"))
