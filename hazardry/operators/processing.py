"""Validate, classify and enrich unified events; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import severity
from hazardry.operators import quality


def process_events(
    events: DataFrame,
    profile: str = "fmi",
    below_min: str = "low",
    processed_at: Column | None = None,
) -> DataFrame:
    """Unified events that pass the process gate, as the eight-column processed event.

    ``event_time`` is the event's ``timestamp`` text, ``processed_at`` the current
    time unless given.
    """
    kind, reading = F.col("event_type"), F.col("severity_raw")
    kept, _ = quality.split_valid(events, "process")
    if below_min == "drop":
        kept = kept.filter(severity.reaches_minimum(kind, reading, profile))
    return (
        kept.withColumn("severity_level", severity.severity_level(kind, reading, profile, below_min))
        .select(
            "event_id",
            "event_type",
            "severity_level",
            "latitude",
            "longitude",
            F.col("timestamp").alias("event_time"),
            (F.current_timestamp() if processed_at is None else processed_at).alias(
                "processed_at"
            ),
            "source",
        )
    )


def processing_report(
    events: DataFrame, profile: str = "fmi", below_min: str = "drop"
) -> DataFrame:
    """One pass over the input: ``measure``, ``value``.

    received, processed, dropped_invalid, dropped_below_threshold, total_dropped,
    pass_rate and drop_rate in percent, then one row per type and per level of
    the processed events.
    """
    return report_of(outcome_counts(events, profile, below_min))


def outcome_counts(events: DataFrame, profile: str = "fmi", below_min: str = "drop") -> DataFrame:
    """One row of counts: received, processed, the two kinds dropped, per type and per level.  Rows of several inputs add up."""
    level = severity.severity_level(F.col("event_type"), F.col("severity_raw"), profile, below_min)
    checked = events.select(
        "event_type", quality.is_valid(events, "process").alias("valid"), level.alias("level")
    )
    passed = F.col("valid") & F.col("level").isNotNull()
    return checked.agg(
        F.count("*").alias("received"),
        F.count_if(passed).alias("processed"),
        F.count_if(~F.col("valid")).alias("dropped_invalid"),
        F.count_if(F.col("valid") & F.col("level").isNull()).alias("dropped_below_threshold"),
        *[F.count_if(passed & (F.col("event_type") == t)).alias(f"type:{t}") for t in C.EVENT_TYPES],
        *[F.count_if(passed & (F.col("level") == v)).alias(f"level:{v}") for v in C.SEVERITY_LEVELS],
    )


def report_of(counts: DataFrame) -> DataFrame:
    """``measure``, ``value`` of one row of :func:`outcome_counts`, with the totals and rates that follow from it."""
    row = counts.withColumn("total_dropped", F.col("dropped_invalid") + F.col("dropped_below_threshold"))
    double = lambda c: c.cast("double")
    rate = lambda part: F.when(
        F.col("received") > 0, double(F.col(part)) / F.col("received") * 100
    ).otherwise(F.lit(0.0))
    row = row.withColumn("pass_rate", rate("processed")).withColumn("drop_rate", rate("total_dropped"))
    names = row.columns
    pairs = F.array(
        *[F.struct(F.lit(n).alias("measure"), double(F.col(f"`{n}`")).alias("value")) for n in names]
    )
    return row.select(F.inline(pairs))


def running_counts(processed: DataFrame) -> DataFrame:
    """Counts by type and level; on a stream, unbounded counters for complete mode."""
    return processed.groupBy("event_type", "severity_level").agg(F.count("*").alias("event_count"))


def critical(processed: DataFrame) -> DataFrame:
    return processed.filter(F.col("severity_level") == "CRITICAL")


def first_per_outcome(
    events: DataFrame, profile: str = "fmi", below_min: str = "drop"
) -> DataFrame:
    """The earliest input event of every outcome: the four levels and DROPPED."""
    level = severity.severity_level(F.col("event_type"), F.col("severity_raw"), profile, below_min)
    outcome = F.when(quality.is_valid(events, "process"), level)
    checked = events.withColumn("outcome", F.coalesce(outcome, F.lit("DROPPED")))
    order = F.struct(F.coalesce("timestamp", F.lit("")), F.coalesce("event_id", F.lit("")))
    row = F.struct("outcome", *events.columns)
    # one aggregation without a key per outcome: rows are neither sorted nor hashed
    firsts = [F.min_by(row, F.when(F.col("outcome") == v, order)) for v in [*C.SEVERITY_LEVELS, "DROPPED"]]
    return checked.agg(F.array_compact(F.array(*firsts)).alias("firsts")).select(F.inline("firsts"))
