"""Raw agency records to canonical events with hazard-specific columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import severity
from hazardry.functions import timestamps as ts
from hazardry.functions.rounding import round_exact


def rupture_area_km2(magnitude: Column) -> Column:
    return round_exact(F.pow(F.lit(10.0), magnitude * C.RUPTURE_AREA_B + C.RUPTURE_AREA_A), 4)


def adapt_quakes(features: DataFrame) -> DataFrame:
    """GeoJSON features to canonical quakes: points with two coordinates and a magnitude."""
    coords = F.col("geometry.coordinates")
    props = "properties."
    keep = (
        (F.col("geometry.type") == "Point")
        & (F.size(coords) >= 2)
        & F.col(props + "mag").isNotNull()
    )
    text = lambda name, default: F.coalesce(F.col(props + name), F.lit(default))
    lon, lat = F.get(coords, F.lit(0)), F.get(coords, F.lit(1))
    mag = F.col(props + "mag")
    fallback_id = F.sha2(F.concat_ws("|", F.col(props + "time"), lon, lat, mag), 256)
    return features.filter(keep).select(
        F.coalesce(F.col("id"), fallback_id).alias("event_id"),
        F.lit("earthquake").alias("event_type"),
        mag.alias("severity_raw"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        ts.iso_text(
            ts.from_epoch_millis(F.coalesce(F.col(props + "time"), F.lit(0).cast("long")))
        ).alias("timestamp"),
        F.lit("USGS_EQ").alias("source"),
        mag.alias("magnitude"),
        rupture_area_km2(mag).alias("area_km2"),
        F.coalesce(F.get(coords, F.lit(2)), F.lit(0.0)).alias("depth_km"),
        F.col(props + "alert").alias("alert_level"),
        (F.coalesce(F.col(props + "tsunami"), F.lit(0)) != 0).alias("tsunami"),
        F.col(props + "sig").alias("significance"),
        text("place", "").alias("place"),
        text("status", "automatic").alias("review_status"),
        text("net", "").alias("network"),
        text("magType", "").alias("magnitude_type"),
        F.col(props + "mmi").alias("mmi"),
        F.col(props + "felt").alias("felt_count"),
    )


def storm_gate(snapshots: DataFrame) -> DataFrame:
    """Weather snapshots with heavy rain, strong wind or any thunderstorm code."""
    low, high = C.THUNDER_CODES
    rain = F.coalesce(F.col("rain.1h"), F.lit(0.0))
    wind = F.coalesce(F.col("wind.speed"), F.lit(0.0))
    thunder = F.coalesce(
        F.exists("weather", lambda w: w["id"].between(low, high)), F.lit(False)
    )
    return snapshots.filter(
        (rain >= C.STORM_MIN_RAIN_1H) | (wind >= C.STORM_MIN_WIND_MS) | thunder
    )


def adapt_storms(snapshots: DataFrame) -> DataFrame:
    """Weather snapshots to canonical storms (gate applied, defaults filled in)."""
    col_or = lambda name, default: F.coalesce(F.col(name), F.lit(default))
    first = F.get("weather", F.lit(0))
    first_or = lambda name, default: F.coalesce(first[name], F.lit(default))
    wind_ms = col_or("wind.speed", 0.0)
    kmh = round_exact(wind_ms * C.MS_TO_KMH, 2)
    epoch = F.coalesce(F.col("dt"), F.lit(0).cast("long"))
    city = F.coalesce(F.col("id"), F.lit(0).cast("long"))
    force = severity.beaufort(wind_ms)
    return storm_gate(snapshots).select(
        F.concat_ws("-", F.lit("OWM"), city, epoch).alias("event_id"),
        F.lit("storm").alias("event_type"),
        kmh.alias("severity_raw"),
        col_or("coord.lat", 0.0).alias("latitude"),
        col_or("coord.lon", 0.0).alias("longitude"),
        ts.iso_text(ts.from_epoch_seconds(epoch)).alias("timestamp"),
        F.lit("OPENWEATHER").alias("source"),
        force.cast("double").alias("magnitude"),
        F.lit(None).cast("double").alias("area_km2"),
        col_or("rain.1h", 0.0).alias("rain_1h_mm"),
        col_or("rain.3h", 0.0).alias("rain_3h_mm"),
        wind_ms.alias("wind_speed_ms"),
        kmh.alias("wind_speed_kmh"),
        F.col("wind.gust").alias("wind_gust_ms"),
        col_or("wind.deg", 0).alias("wind_direction"),
        col_or("main.pressure", 1013).alias("pressure_hpa"),
        col_or("main.humidity", 0).alias("humidity_pct"),
        F.col("visibility").alias("visibility_m"),
        col_or("clouds.all", 0).alias("cloud_cover_pct"),
        first_or("main", "").alias("condition_main"),
        first_or("id", 0).alias("condition_id"),
        first_or("description", "").alias("condition_desc"),
        col_or("name", "").alias("city_name"),
        col_or("sys.country", "").alias("country_code"),
        force.alias("beaufort_scale"),
    )
