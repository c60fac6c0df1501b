"""High-water marks to flood events with a flood magnitude index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions import timestamps as ts
from hazardry.functions.lookup import map_or
from hazardry.functions.rounding import round_exact
from hazardry.operators.hull import hull_area


def flood_events(marks: DataFrame) -> DataFrame:
    """One canonical event per flood ``event_id``.

    ``marks`` holds event_id, latitude_dd, longitude_dd, elev_ft, hwm_quality_id,
    flag_date (timestamp, NULL if it did not parse), hwm_environment, stateName,
    waterbody, eventName and ``row_no``, the file order of the marks.

    The index weighs hull area, depth proxy and duration.  A flood is left out
    when all its marks are poor and there are fewer than three of them.  Marks
    that lack a position, an elevation or a quality take no part; see
    :func:`flood_rejects`.
    """
    marks = marks.filter(_fault().isNull())
    usable = F.col("hwm_quality_id") <= C.FLOOD_USABLE_QUALITY
    marks = marks.withColumn("usable", usable)
    count_of = lambda cond: F.count_if(cond)
    pick = lambda name: F.when(F.col("usable"), F.col(name))
    text_or = lambda name, default: F.coalesce(F.col(name), F.lit(default)).alias(name)

    facts = marks.groupBy("event_id").agg(
        F.count("*").alias("hwm_count"),
        count_of(F.col("usable")).alias("usable_count"),
        F.min("hwm_quality_id").alias("best_quality"),
        F.avg(pick("latitude_dd")).alias("lat_usable"),
        F.avg(pick("longitude_dd")).alias("lon_usable"),
        F.avg("latitude_dd").alias("lat_all"),
        F.avg("longitude_dd").alias("lon_all"),
        F.avg("elev_ft").alias("mean_elev"),
        F.min("elev_ft").alias("min_elev"),
        F.min("flag_date").alias("first_flag"),
        F.max("flag_date").alias("last_flag"),
        F.min_by(
            F.struct(
                text_or("hwm_environment", "Riverine"),
                text_or("stateName", ""),
                text_or("waterbody", ""),
                text_or("eventName", ""),
            ),
            "row_no",
        ).alias("first_mark"),
    )
    kept = facts.filter(
        (F.col("best_quality") <= C.FLOOD_USABLE_QUALITY)
        | (F.col("hwm_count") >= C.FLOOD_MIN_MARKS)
    ).withColumn("usable", F.col("usable_count") > 0)

    # usable marks span the hull; without any, all marks (then all unusable) do
    hulls = hull_area(marks, ["event_id", "usable"], "latitude_dd", "longitude_dd")
    joined = kept.join(hulls, ["event_id", "usable"]).withColumn(
        # the gate counts points before equal ones are merged
        "point_count",
        F.when(F.col("usable"), F.col("usable_count")).otherwise(F.col("hwm_count")),
    )

    span_hours = (
        F.unix_micros("last_flag") - F.unix_micros("first_flag")
    ) / F.lit(3600.0 * 1e6)
    measured = joined.select(
        "*",
        F.when(F.col("usable"), F.col("lat_usable")).otherwise(F.col("lat_all")).alias("lat_c"),
        F.when(F.col("usable"), F.col("lon_usable")).otherwise(F.col("lon_all")).alias("lon_c"),
        F.least(
            F.lit(5.0), (F.col("mean_elev") - F.col("min_elev")) * C.FEET_TO_M / 2.0
        ).alias("depth_score"),
        F.when(F.col("first_flag").isNull(), F.lit(C.FLOOD_UNKNOWN_HOURS))
        .otherwise(F.greatest(F.lit(1.0), span_hours))
        .alias("hours"),
    ).withColumn(
        "area",
        F.when(
            F.col("point_count") >= C.FLOOD_MIN_MARKS,
            geo.square_degrees_to_km2(F.col("hull_area"), F.col("lat_c")),
        ).otherwise(F.lit(C.FLOOD_POINT_AREA_KM2)),
    )
    weights = C.FLOOD_WEIGHTS
    index = F.greatest(
        F.lit(0.0),
        round_exact(
            F.log10(F.col("area") + 1) * weights["area"]
            + F.col("depth_score") * weights["depth"]
            + F.log10(F.col("hours") + 1) * weights["time"],
            4,
        ),
    )
    return measured.withColumn("fmi", index).select(
        F.concat_ws("-", F.lit("USGS-FLOOD"), "event_id").alias("event_id"),
        F.lit("flood").alias("event_type"),
        F.col("fmi").alias("severity_raw"),
        round_exact(F.col("lat_c"), 6).alias("latitude"),
        round_exact(F.col("lon_c"), 6).alias("longitude"),
        F.coalesce(ts.iso_text(F.col("first_flag")), F.lit(C.FALLBACK_FLOOD_TIMESTAMP)).alias(
            "timestamp"
        ),
        F.lit("USGS_FLOOD").alias("source"),
        F.col("fmi").alias("magnitude"),
        round_exact(F.col("area"), 4).alias("area_km2"),
        F.col("event_id").alias("flood_event_id"),
        F.col("first_mark.eventName").alias("flood_event_name"),
        "hwm_count",
        round_exact(F.col("mean_elev"), 2).alias("water_elevation_ft"),
        map_or(F.col("best_quality"), C.FLOOD_QUALITY, "Unknown").alias("quality"),
        F.col("first_mark.hwm_environment").alias("environment"),
        F.col("first_mark.stateName").alias("state"),
        F.col("first_mark.waterbody").alias("waterbody"),
        "fmi",
        round_exact(F.col("hours"), 1).alias("duration_hours"),
    )


def _fault() -> Column:
    """The first field of a mark that an event cannot do without and that is missing."""
    numbers = [F.when(F.nanvl(c, F.lit(None)).isNull(), F.lit(c)) for c in ("latitude_dd", "longitude_dd", "elev_ft")]
    return F.coalesce(
        F.when(F.col("event_id").isNull(), F.lit("event_id")),
        *numbers,
        F.when(F.col("hwm_quality_id").isNull(), F.lit("hwm_quality_id")),
    )


def flood_rejects(marks: DataFrame) -> DataFrame:
    """Marks that take no part in any flood, with the field that is missing in ``reason``."""
    return marks.withColumn("reason", _fault()).filter(F.col("reason").isNotNull())


def parse_marks(raw: DataFrame) -> DataFrame:
    """Text ``flag_date`` (ISO, no zone) to a timestamp; unparseable becomes NULL."""
    return raw.withColumn("flag_date", F.try_to_timestamp("flag_date"))
