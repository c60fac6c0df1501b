"""Raw agency records to the unified event schema (one operator per hazard)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import timestamps as ts
from hazardry.functions.lookup import map_or
from hazardry.functions.predicates import all_of
from hazardry.functions.rounding import round_exact
from hazardry.schemas import UNIFIED_EVENT

UNIFIED_COLUMNS = UNIFIED_EVENT.fieldNames()


def natural_id(*parts: Column | str) -> Column:
    """Deterministic event id: reruns over the same records give the same ids."""
    return F.sha2(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]), 256)


def normalize_quakes(raw: DataFrame) -> DataFrame:
    """GeoJSON features (id, properties, geometry) to unified events."""
    coords = F.col("geometry.coordinates")
    return raw.select(
        natural_id(
            F.lit("earthquake"),
            "id",
            "properties.time",
            F.get(coords, F.lit(0)),
            F.get(coords, F.lit(1)),
            "properties.mag",
        ).alias("event_id"),
        F.lit("earthquake").alias("event_type"),
        F.col("properties.mag").alias("severity_raw"),
        F.get(coords, F.lit(1)).alias("latitude"),
        F.get(coords, F.lit(0)).alias("longitude"),
        ts.iso_text(ts.from_epoch_millis(F.col("properties.time"))).alias("timestamp"),
        map_or(F.col("properties.net"), C.NETWORK_AGENCY, C.DEFAULT_AGENCY).alias("source"),
    )


def normalize_fires(raw: DataFrame) -> DataFrame:
    """Single fire detections (ISO acq_date, HHMM acq_time, frp in MW) to unified events."""
    return raw.select(
        natural_id(F.lit("fire"), "acq_date", "acq_time", "latitude", "longitude", "frp").alias(
            "event_id"
        ),
        F.lit("fire").alias("event_type"),
        F.col("frp").alias("severity_raw"),
        "latitude",
        "longitude",
        ts.date_and_hhmm_text(F.col("acq_date"), F.col("acq_time")).alias("timestamp"),
        F.lit("NASA-FIRMS").alias("source"),
    )


def normalize_floods(raw: DataFrame) -> DataFrame:
    """High-water records (height above ground in feet) to unified events in centimetres."""
    return raw.select(
        natural_id(
            F.lit("flood"), "hwm_id", "peak_date", "site_latitude", "site_longitude"
        ).alias("event_id"),
        F.lit("flood").alias("event_type"),
        round_exact(F.col("height_above_gnd_ft") * C.FEET_TO_CM, 2).alias("severity_raw"),
        F.col("site_latitude").alias("latitude"),
        F.col("site_longitude").alias("longitude"),
        ts.ensure_z(F.col("peak_date")).alias("timestamp"),
        F.lit("USGS-HWM").alias("source"),
    )


def normalize_storms(raw: DataFrame) -> DataFrame:
    """Best-track records (wind in knots, NULL counts as calm) to unified events in km/h."""
    wind = F.coalesce(F.col("wmo_wind"), F.lit(0.0))
    return raw.select(
        natural_id(F.lit("storm"), "sid", "iso_time", "lat", "lon").alias("event_id"),
        F.lit("storm").alias("event_type"),
        round_exact(wind * C.KNOTS_TO_KMH, 1).alias("severity_raw"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.concat(F.replace("iso_time", F.lit(" "), F.lit("T")), F.lit("Z")).alias("timestamp"),
        F.lit("IBTrACS").alias("source"),
    )


NORMALIZERS = {
    "earthquake": normalize_quakes,
    "fire": normalize_fires,
    "flood": normalize_floods,
    "storm": normalize_storms,
}


def malformed_field(required: list[str]) -> Column:
    """Name of the first required field without a value, NULL when all are there."""
    return F.coalesce(*[F.when(F.col(name).isNull(), F.lit(name)) for name in required])


def normalize_all(raw_by_type: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Normalise every feed; returns (events, rejects).

    A record that lacks a value the event needs goes to ``rejects`` with the
    name of the first missing field in ``reason``.
    """
    unified = reduce(
        DataFrame.unionByName, [NORMALIZERS[kind](raw) for kind, raw in raw_by_type.items()]
    )
    required = ["severity_raw", "latitude", "longitude", "timestamp"]
    complete = all_of(F.col(name).isNotNull() for name in required)
    rejects = unified.filter(~complete).withColumn("reason", malformed_field(required))
    return unified.filter(complete), rejects
