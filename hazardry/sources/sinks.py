"""Writers: feeds per type, canonical events per hazard, topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions.lookup import map_or
from hazardry.operators.quality import require_valid


def write_unified(events: DataFrame, folder: str) -> dict[str, str]:
    """Unified events as JSON, one sub-folder per type; fails if any row is invalid.

    All types are written in one pass.  Returns the folder of every type.
    """
    require_valid(events)
    (
        events.withColumn("feed", F.col("event_type"))
        .write.mode("overwrite")
        .partitionBy("feed")
        .json(folder, ignoreNullFields=False)
    )
    return {kind: f"{folder}/feed={kind}" for kind in C.EVENT_TYPES}


def write_canonical(events_by_hazard: dict[str, DataFrame], folder: str) -> None:
    """Canonical events as JSON, one folder per hazard, replacing what was there."""
    for kind, events in events_by_hazard.items():
        events.write.mode("overwrite").json(f"{folder}/{C.FEED_FILES[kind]}")


def topic_messages(events: DataFrame) -> DataFrame:
    """``topic`` by type, ``key`` the event id, ``value`` the whole event as JSON."""
    value = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    return events.select(
        map_or(F.col("event_type"), C.TOPICS, None).alias("topic"),
        F.col("event_id").alias("key"),
        value.alias("value"),
    )


def publish_to_kafka(events: DataFrame, servers: str) -> None:
    """Batch publish of valid events; needs the Kafka connector on the class path."""
    (
        topic_messages(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
