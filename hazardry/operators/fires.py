"""Satellite fire pixels to fire events: one event per half-degree cell and day.

The grouping is a plain aggregation, so a cell with a third of all pixels is
combined on the map side and never gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions import timestamps as ts
from hazardry.functions.lookup import map_or
from hazardry.functions.rounding import round_exact


@dataclass(frozen=True)
class Sensor:
    """How one sensor's pixel table differs from another's."""

    name: str
    brightness: str
    background: str
    default_satellite: str
    default_extent: float
    viirs_confidence: bool = field(default=False)

    @property
    def source(self) -> str:
        return f"NASA_FIRMS_{self.name}"


MODIS = Sensor("MODIS", "brightness", "bright_t31", "", 1.0)
VIIRS = Sensor("VIIRS", "bright_ti4", "bright_ti5", "N", 0.5, viirs_confidence=True)


def parse_pixels(text: DataFrame, sensor: Sensor) -> DataFrame:
    """All-text CSV rows to typed pixels; ``reason`` names the first field that fails.

    A MODIS confidence is an integer, a VIIRS one a letter.  The five core fields
    must be numbers; another field may be absent, but if it is there it must be one.
    """
    core = ["confidence", "type", "frp", "latitude", "longitude"]
    optional = [sensor.brightness, sensor.background, "scan", "track", "acq_time"]
    whole = {"type", "acq_time", "confidence"}

    def typed(name: str) -> Column:
        if name == "confidence" and sensor.viirs_confidence:
            return F.lower(F.trim(F.coalesce(F.col(name), F.lit("n"))))
        return F.trim(F.col(name)).try_cast("int" if name in whole else "double")

    failures = [F.when(typed(n).isNull(), F.lit(n)) for n in core]
    failures += [F.when(typed(n).isNull() & F.col(n).isNotNull(), F.lit(n)) for n in optional]
    texts = [n for n in text.columns if n not in core and n not in optional]
    return text.select(
        *[typed(n).alias(n) for n in core + optional],
        *texts,
        F.coalesce(*failures).alias("reason"),
    )


def located(pixels: DataFrame) -> Column:
    """Whether a pixel has what an event is made of: a position, a power and a day."""
    numbers = [F.nanvl(c, F.lit(None)).isNotNull() for c in ("latitude", "longitude", "frp")]
    sound = reduce(and_, numbers, F.col("acq_date").isNotNull())
    return sound & F.col("reason").isNull() if "reason" in pixels.columns else sound


def fire_rejects(pixels: DataFrame) -> DataFrame:
    """Pixels that cannot join a cluster, each with the first field that fails in ``reason``."""
    missing = [
        *[F.when(F.nanvl(c, F.lit(None)).isNull(), F.lit(c)) for c in ("latitude", "longitude", "frp")],
        F.when(F.col("acq_date").isNull(), F.lit("acq_date")),
    ]
    parsed = [F.col("reason")] if "reason" in pixels.columns else []
    return pixels.filter(~located(pixels)).withColumn("reason", F.coalesce(*parsed, *missing))


def fires_from_text(text: DataFrame, sensor: Sensor, row_no: Column | None = None) -> DataFrame:
    """File to fire events: parse all-text rows, leave out what fails, cluster the rest.

    ``row_no`` is the order of the rows; without it the order of reading.
    """
    order = F.monotonically_increasing_id() if row_no is None else row_no
    return cluster_fires(parse_pixels(text, sensor).withColumn("row_no", order), sensor)


def usable_pixels(pixels: DataFrame, sensor: Sensor) -> DataFrame:
    """Reliable vegetation-fire pixels with a numeric ``confidence_pct``."""
    vegetation = F.col("type") == 0
    if sensor.viirs_confidence:
        letter = F.lower(F.trim(F.coalesce(F.col("confidence"), F.lit("n"))))
        score = map_or(letter, C.VIIRS_CONFIDENCE_SCORE, C.VIIRS_DEFAULT_SCORE)
        return pixels.filter((letter != "l") & vegetation).withColumn("confidence_pct", score)
    confident = F.col("confidence") >= C.MODIS_MIN_CONFIDENCE
    return pixels.filter(confident & vegetation).withColumn(
        "confidence_pct", F.col("confidence")
    )


def cluster_fires(pixels: DataFrame, sensor: Sensor) -> DataFrame:
    """Aggregate pixels into canonical fire events; see :func:`fire_rejects` for those left out.

    ``pixels`` holds latitude, longitude, frp, scan, track, acq_date (DD-MM-YYYY
    text), acq_time (HHMM), satellite, daynight, confidence, type, the sensor's
    two temperature columns and ``row_no``, the file order that settles which of
    several pixels of the same minute came first.
    """
    usable = usable_pixels(pixels.filter(located(pixels)), sensor)
    extent = lambda name: F.coalesce(F.col(name), F.lit(sensor.default_extent))
    acq_time = F.coalesce(F.col("acq_time"), F.lit(0))
    first = F.min_by(
        F.struct(
            acq_time.alias("acq_time"),
            F.coalesce(F.col("satellite"), F.lit(sensor.default_satellite)).alias("satellite"),
            F.coalesce(F.col("daynight"), F.lit("D")).alias("daynight"),
        ),
        F.struct(acq_time, F.col("row_no")),
    )
    mean1 = lambda c: round_exact(F.avg(c), 1)
    zero = F.lit(0.0)
    grouped = (
        usable.groupBy(
            geo.floor_cell(F.col("latitude"), C.FIRE_CELL_DEGREES).alias("cell_lat"),
            geo.floor_cell(F.col("longitude"), C.FIRE_CELL_DEGREES).alias("cell_lon"),
            "acq_date",
        )
        .agg(
            round_exact(F.sum("frp"), 2).alias("frp_mw"),
            round_exact(F.sum(extent("scan") * extent("track")), 4).alias("area_km2"),
            F.sum(F.col("latitude") * F.col("frp")).alias("lat_frp"),
            F.sum(F.col("longitude") * F.col("frp")).alias("lon_frp"),
            F.count("*").alias("pixel_count"),
            mean1("confidence_pct").alias("confidence_pct"),
            mean1(F.coalesce(F.col(sensor.brightness), zero)).alias("brightness_k"),
            mean1(F.coalesce(F.col(sensor.background), zero)).alias("background_temp_k"),
            first.alias("first"),
        )
        .filter(F.col("frp_mw") >= C.FIRE_MIN_MW)
    )
    return grouped.select(
        F.format_string(
            f"FIRMS-{sensor.name}-%.2f-%.2f-%s", "cell_lat", "cell_lon", "acq_date"
        ).alias("event_id"),
        F.lit("fire").alias("event_type"),
        F.col("frp_mw").alias("severity_raw"),
        # the weighted centroid divides by the rounded sum
        round_exact(F.col("lat_frp") / F.col("frp_mw"), 6).alias("latitude"),
        round_exact(F.col("lon_frp") / F.col("frp_mw"), 6).alias("longitude"),
        ts.day_first_date_and_hhmm(
            F.col("acq_date"), F.col("first.acq_time"), C.FALLBACK_FIRE_TIMESTAMP
        ).alias("timestamp"),
        F.lit(sensor.source).alias("source"),
        round_exact(F.log10(F.col("frp_mw") + 1), 4).alias("magnitude"),
        "area_km2",
        "frp_mw",
        "pixel_count",
        "confidence_pct",
        "brightness_k",
        "background_temp_k",
        F.col("first.satellite").alias("satellite"),
        F.col("first.daynight").alias("daynight"),
    )


def union_sensors(*fires: DataFrame) -> DataFrame:
    """All sensors' fire events; one fire seen by two sensors stays two events."""
    out = fires[0]
    for other in fires[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
