"""Processed events to documents with a GeoJSON point, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry.functions import timestamps as ts


def _point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def _as_time(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName() == "string":
        return ts.parse_iso(F.col(name))
    return F.col(name).cast("timestamp")


def to_document(events: DataFrame) -> DataFrame:
    """Flat events to documents: ``_id``, a GeoJSON ``location`` in [lon, lat] order, real times."""
    replaced = ("event_id", "latitude", "longitude", "event_time", "processed_at")
    rest = [c for c in events.columns if c not in replaced]
    times = [
        _as_time(events, c).alias(c) for c in ("event_time", "processed_at") if c in events.columns
    ]
    return events.select(
        F.col("event_id").alias("_id"),
        *rest,
        _point(F.col("longitude"), F.col("latitude")).alias("location"),
        *times,
    )


def replay_document(events: DataFrame, now: Column | None = None) -> DataFrame:
    """As :func:`to_document`, for replayed events: a bad event time becomes now."""
    now = F.current_timestamp() if now is None else now
    documents = to_document(events.withColumn("processed_at", now))
    return documents.withColumn("event_time", F.coalesce("event_time", now))


def flatten_document(documents: DataFrame) -> DataFrame:
    """Documents to flat events; a document without a location sits at 0, 0."""
    coordinates = F.col("location.coordinates")
    rest = [c for c in documents.columns if c not in ("_id", "location")]
    return documents.select(
        F.col("_id").alias("event_id"),
        *rest,
        F.coalesce(F.get(coordinates, F.lit(1)), F.lit(0.0)).alias("latitude"),
        F.coalesce(F.get(coordinates, F.lit(0)), F.lit(0.0)).alias("longitude"),
    )


def flatten_live(documents: DataFrame) -> DataFrame:
    """Live documents to flat rows: own latitude and longitude, times as ISO text."""
    dropped = ("_id", "event_id", "location", "is_live", "latitude", "longitude", "event_time", "processed_at")
    rest = [c for c in documents.columns if c not in dropped]
    return documents.select(
        F.col("_id").alias("event_id"),
        *rest,
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
        ts.iso_text(F.col("event_time")).alias("event_time"),
        ts.iso_text(F.col("processed_at")).alias("processed_at"),
    )
