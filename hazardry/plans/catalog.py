"""Registered queries: every operator on inputs derived from the given tables.

A query takes (spark, folder of tables) and returns a DataFrame.  The SQL twins
are in :mod:`hazardry.plans.twins`; names and types of the columns agree.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry import schemas
from hazardry.functions import geo, severity
from hazardry.functions import timestamps as ts
from hazardry.operators import (
    adapters,
    analytics,
    documents,
    fires,
    floods,
    hull,
    mapview,
    normalize,
    places,
    processing,
    quality,
    ranking,
    search,
)
from hazardry.operators import star as S
from hazardry.plans import warehouse as W
from hazardry.plans.keyset import KeySet
from hazardry.plans.lifts import lift, lift_stream
from hazardry.sources import docstore, readers, sinks
from hazardry.sources.workspace import fresh_folder, scratch, staged
from hazardry.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# literal parameters of the registered queries; the SQL twins use the same
AS_OF = "2024-01-15 12:00:00"
BOX = (20.0, 50.0, 60.0, 120.0)
GEODESIC_BOX = (20.003, 50.003, 60.003, 120.003)
WORLD = (-90.0, 90.0, -180.0, 180.0)
RANGE = ("1996-03-01", "1999-10-31")
FULL_RANGE = ("1980-01-01", "2030-12-31")
CENTER = (30.0, 80.0, 500.0)
UPSERT_OMITS = "source"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs ------------------------------------------------------------------------


def _unified(spark: SparkSession, d: str, name: str = "live_dirty") -> DataFrame:
    """Unified events (text timestamp); live_dirty also carries processed_at."""
    events = lift(spark, d, name)
    return events.withColumn("timestamp", ts.iso_text(F.col("event_time"))).drop("event_time")


def _processed(spark: SparkSession, d: str) -> DataFrame:
    return processing.process_events(
        _unified(spark, d), "cm", "drop", processed_at=F.col("processed_at")
    )


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Processed events as the store holds them: last write per id, real times, flat."""
    latest = ranking.keep_one(_processed(spark, d), "event_id", ["processed_at"], "last")
    return documents.flatten_document(documents.to_document(latest))


def _texts(df: DataFrame) -> DataFrame:
    """Times and dates as ISO text, so both engines print them alike."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    texts = {c: ts.iso_text(F.col(c)) for c, kind in kinds.items() if kind == "timestamp"}
    texts |= {c: F.date_format(c, "yyyy-MM-dd") for c, kind in kinds.items() if kind == "date"}
    return df.withColumns(texts) if texts else df


def _hist(spark: SparkSession, d: str) -> DataFrame:
    """Classified history with an event_time."""
    hist = lift(spark, d, "hist")
    at = F.col("event_date").cast("timestamp") + F.make_dt_interval(hours=F.col("event_hour"))
    return W.classify_events(hist.withColumn("event_time", at))


_STARS: dict[tuple, S.Star] = {}


def _star(spark: SparkSession, d: str) -> S.Star:
    """The stored star schema of the history, loaded on first use in a session and again
    when a table it comes from has changed."""
    inputs = [f"{d.rstrip('/')}/{name}.parquet" for name in ("orders", "customer", "nation")]
    key = (spark.sparkContext.applicationId, d, *[readers.modified_at(spark, p) for p in inputs])
    if key not in _STARS:
        store = W.Warehouse(spark, fresh_folder(spark, "warehouse"))
        store.load(_hist(spark, d), lift(spark, d, "gaz"))
        _STARS[key] = store.open()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _STARS[key]


def _pixels(spark: SparkSession, d: str, sensor: fires.Sensor) -> DataFrame:
    pix = lift(spark, d, "pix")
    if sensor.viirs_confidence:
        pix = pix.withColumn("confidence", F.col("confidence_class"))
    return pix.drop("confidence_class").withColumnsRenamed(
        {"brightness": sensor.brightness, "background": sensor.background}
    )


def _marks(spark: SparkSession, d: str) -> DataFrame:
    return lift(spark, d, "hwm").drop("x", "y")


def _quake_features(spark: SparkSession, d: str) -> DataFrame:
    raw = lift(spark, d, "raw_quake")
    absent = lambda kind: F.lit(None).cast(kind)
    coordinates = F.when(F.col("depth").isNull(), F.array("lon", "lat")).otherwise(
        F.array("lon", "lat", "depth")
    )
    return raw.select(
        "id",
        F.struct(
            "mag",
            F.col("time_ms").alias("time"),
            F.concat(F.lit("near "), "id").alias("place"),
            "net",
            "status",
            "tsunami",
            "sig",
            absent("string").alias("magType"),
            absent("string").alias("alert"),
            absent("double").alias("mmi"),
            absent("int").alias("felt"),
        ).alias("properties"),
        F.struct(F.col("shape").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
    )


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    raw = lift(spark, d, "raw_weather")
    absent = lambda kind: F.lit(None).cast(kind)
    sky = lambda code: F.struct(
        F.col(code).alias("id"),
        F.concat(F.lit("W"), F.col(code).cast("string")).alias("main"),
        F.lit("sky").alias("description"),
    )
    return raw.select(
        F.struct("lat", "lon").alias("coord"),
        "dt",
        F.col("city_id").alias("id"),
        F.col("city_name").alias("name"),
        F.struct(
            F.col("wind_ms").alias("speed"), F.col("gust_ms").alias("gust"), absent("int").alias("deg")
        ).alias("wind"),
        F.struct("pressure", absent("int").alias("humidity")).alias("main"),
        F.struct(F.col("rain_1h").alias("1h"), absent("double").alias("3h")).alias("rain"),
        absent("int").alias("visibility"),
        F.struct(absent("int").alias("all")).alias("clouds"),
        F.array(sky("code_1"), sky("code_2")).alias("weather"),
        F.struct(absent("string").alias("country")).alias("sys"),
    )


def _fire_records(spark: SparkSession, d: str) -> DataFrame:
    return lift(spark, d, "raw_fire")


def _flood_records(spark: SparkSession, d: str) -> DataFrame:
    return lift(spark, d, "raw_flood")


def _storm_records(spark: SparkSession, d: str) -> DataFrame:
    return lift(spark, d, "raw_storm")


# --- sources -------------------------------------------------------------------------


@query
def src_geojson_quakes(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_folder(spark, "geojson")
    _quake_features(spark, d).select(F.array(F.struct("*")).alias("features")).write.json(path)
    return adapters.adapt_quakes(readers.quake_features(spark, path, multi_line=False)).drop(
        "alert_level", "magnitude_type", "mmi", "felt_count"
    )


def _pixel_file(spark: SparkSession, d: str, sensor: fires.Sensor, columns: list[str]) -> str:
    """Pixels as a CSV folder, some with a confidence or radiative power that is no number."""
    path = fresh_folder(spark, "pixels")
    pixels = _pixels(spark, d, sensor)
    broken = F.when(F.col("row_no") % 67 == 0, F.lit("n/a")).otherwise(F.col("frp").cast("string"))
    filled = pixels.withColumns(
        {"frp": broken, "instrument": F.lit(sensor.name), "version": F.col("row_no").cast("string")}
    )
    filled.select(*[F.col(c).cast("string") for c in columns]).write.csv(path, header=True)
    return path


def _read_pixels(text: DataFrame, sensor: fires.Sensor) -> DataFrame:
    return fires.parse_pixels(text, sensor).select(
        F.col("version").cast("long").alias("row_no"),
        "latitude",
        "longitude",
        "frp",
        "scan",
        "track",
        "acq_date",
        "acq_time",
        "satellite",
        "confidence",
        F.col(sensor.brightness).alias("brightness"),
        "type",
        "reason",
    )


@query
def src_firms_modis(spark: SparkSession, d: str) -> DataFrame:
    path = _pixel_file(spark, d, fires.MODIS, schemas.MODIS_PIXEL_TEXT.fieldNames())
    return _read_pixels(readers.modis_text(spark, path), fires.MODIS)


@query
def src_firms_viirs(spark: SparkSession, d: str) -> DataFrame:
    path = _pixel_file(spark, d, fires.VIIRS, schemas.VIIRS_PIXEL_TEXT.fieldNames())
    return _read_pixels(readers.viirs_text(spark, path), fires.VIIRS)


@query
def src_hwm_json(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_folder(spark, "marks")
    marks = _marks(spark, d)
    text = F.date_format("flag_date", "yyyy-MM-dd'T'HH:mm:ss")
    marks.withColumn("flag_date", text).drop("row_no").write.json(path)
    read = floods.parse_marks(readers.high_water_marks(spark, path, multi_line=False))
    return _texts(read).groupBy(*read.columns).agg(F.count("*").alias("copies"))


@query
def src_openweather_json(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_folder(spark, "weather")
    _snapshots(spark, d).write.json(path)
    read = readers.weather_snapshots(spark, path, multi_line=False)
    return read.select(
        "dt",
        "id",
        F.col("coord.lat").alias("lat"),
        F.col("coord.lon").alias("lon"),
        F.col("wind.speed").alias("wind_ms"),
        F.col("rain.1h").alias("rain_1h"),
        F.col("main.pressure").alias("pressure"),
        F.size("weather").alias("conditions"),
    )


@query
def src_union_feeds(spark: SparkSession, d: str) -> DataFrame:
    events, _ = quality.split_valid(_unified(spark, d, "live"), "strict")
    folders = sinks.write_unified(events.select(*schemas.UNIFIED_EVENT.fieldNames()), fresh_folder(spark, "feeds"))
    missing = fresh_folder(spark, "no-such-feed")
    return readers.union_feeds(spark, [*folders.values(), missing], multi_line=False)


# --- normalisers and adapters ----------------------------------------------------------


@query
def norm_quake(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_quakes(_quake_features(spark, d))


@query
def norm_fire(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_fires(_fire_records(spark, d))


@query
def norm_flood(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_floods(_flood_records(spark, d))


@query
def norm_storm(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_storms(_storm_records(spark, d))


def _raw_by_type(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "earthquake": _quake_features(spark, d),
        "fire": _fire_records(spark, d),
        "flood": _flood_records(spark, d),
        "storm": _storm_records(spark, d),
    }


@query
def norm_all(spark: SparkSession, d: str) -> DataFrame:
    events, _ = normalize.normalize_all(_raw_by_type(spark, d))
    return events


@query
def norm_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = normalize.normalize_all(_raw_by_type(spark, d))
    return rejects.groupBy("event_type", "reason").agg(F.count("*").alias("row_count"))


@query
def quake_area(spark: SparkSession, d: str) -> DataFrame:
    return adapters.adapt_quakes(_quake_features(spark, d)).select(
        "event_id", "magnitude", "area_km2", "depth_km", "tsunami", "review_status", "network", "timestamp"
    )


@query
def storm_gate(spark: SparkSession, d: str) -> DataFrame:
    return adapters.storm_gate(_snapshots(spark, d)).select("dt", "id", F.col("name").alias("city_name"))


@query
def storm_adapter(spark: SparkSession, d: str) -> DataFrame:
    return adapters.adapt_storms(_snapshots(spark, d)).drop("area_km2", "visibility_m")


@query
def beaufort(spark: SparkSession, d: str) -> DataFrame:
    force = severity.beaufort(F.col("wind_ms"))
    return (
        lift(spark, d, "raw_weather")
        .filter(F.col("wind_ms").isNotNull())
        .groupBy(force.alias("beaufort_scale"))
        .agg(F.count("*").alias("row_count"), F.min("wind_ms").alias("slowest"), F.max("wind_ms").alias("fastest"))
    )


@query
def storm_basin(spark: SparkSession, d: str) -> DataFrame:
    basin = severity.storm_basin(F.col("lat"), F.col("lon"))
    nature = severity.storm_nature(F.coalesce("wmo_wind", F.lit(0.0)), basin)
    return lift(spark, d, "raw_storm").select("sid", basin.alias("basin"), nature.alias("nature"))


# --- validation, classification, processing ------------------------------------------------


@query
def validate_strict(spark: SparkSession, d: str) -> DataFrame:
    _, rejects = quality.split_valid(_unified(spark, d), "strict")
    return rejects.withColumn("reasons", F.array_join("reasons", "; ")).drop("processed_at")


@query
def validate_publish(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = quality.split_valid(_unified(spark, d), "publish")
    return valid.drop("processed_at")


@query
def validate_process(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = quality.split_valid(_unified(spark, d), "process")
    return valid.drop("processed_at")


def _levels(spark: SparkSession, d: str, profile: str, below: str) -> DataFrame:
    level = severity.severity_level(F.col("event_type"), F.col("severity_raw"), profile, below)
    return lift(spark, d, "live_dirty").select("event_id", "event_type", "severity_raw", level.alias("severity_level"))


@query
def classify_fmi(spark: SparkSession, d: str) -> DataFrame:
    return _levels(spark, d, "fmi", "low")


@query
def classify_cm_drop(spark: SparkSession, d: str) -> DataFrame:
    return _levels(spark, d, "cm", "drop").filter(F.col("severity_level").isNotNull())


@query
def severity_summary(spark: SparkSession, d: str) -> DataFrame:
    out = analytics.severity_summary(lift(spark, d, "live").filter(F.col("event_type").isNotNull()))
    return out.withColumn("mean_severity", F.round("mean_severity", 5))


@query
def severity_distribution(spark: SparkSession, d: str) -> DataFrame:
    return analytics.severity_distribution(lift(spark, d, "live"), "fmi")


@query
def process_events(spark: SparkSession, d: str) -> DataFrame:
    return _texts(_processed(spark, d))


@query
def processing_stats(spark: SparkSession, d: str) -> DataFrame:
    return processing.processing_report(_unified(spark, d), "cm", "drop")


@query
def first_per_level(spark: SparkSession, d: str) -> DataFrame:
    return processing.first_per_outcome(_unified(spark, d).drop("processed_at"), "cm", "drop")


@query
def critical_alerts(spark: SparkSession, d: str) -> DataFrame:
    return _texts(processing.critical(_processed(spark, d)))


@query
def dq_min_count(spark: SparkSession, d: str) -> DataFrame:
    return quality.minimum_counts(lift(spark, d, "live_dirty"))


@query
def dq_schema(spark: SparkSession, d: str) -> DataFrame:
    return quality.schema_report(_unified(spark, d))


@query
def dq_spread(spark: SparkSession, d: str) -> DataFrame:
    return quality.spread_report(lift(spark, d, "live"))


@query
def dq_zeros(spark: SparkSession, d: str) -> DataFrame:
    return quality.noise_report(lift(spark, d, "live_dirty"))


@query
def dq_timestamps(spark: SparkSession, d: str) -> DataFrame:
    events = _unified(spark, d)
    # one source writes its times with a blank instead of a T
    odd = F.when(F.col("source") == "SRC-4", F.replace("timestamp", F.lit("T"), F.lit(" ")))
    return quality.timestamp_report(events.withColumn("timestamp", F.coalesce(odd, "timestamp")))


# --- documents and the document store -------------------------------------------------------


@query
def to_document(spark: SparkSession, d: str) -> DataFrame:
    docs = documents.to_document(_processed(spark, d))
    return _texts(docs).select(
        "_id",
        "event_type",
        "severity_level",
        "source",
        F.col("location.type").alias("geo_type"),
        F.get("location.coordinates", F.lit(0)).alias("coord_0"),
        F.get("location.coordinates", F.lit(1)).alias("coord_1"),
        "event_time",
        "processed_at",
    )


@query
def doc_flatten(spark: SparkSession, d: str) -> DataFrame:
    docs = documents.to_document(_processed(spark, d))
    # documents of one source have lost their location
    located = F.when(F.col("source") != "SRC-1", F.col("location"))
    return _texts(documents.flatten_document(docs.withColumn("location", located)))


@query
def live_flatten(spark: SparkSession, d: str) -> DataFrame:
    processed = _processed(spark, d)
    docs = documents.to_document(processed.withColumns({"lat": F.col("latitude"), "lon": F.col("longitude")}))
    live = docs.withColumns({"latitude": F.col("lat"), "longitude": F.col("lon"), "is_live": F.lit(True)})
    return documents.flatten_live(live.drop("lat", "lon"))


@query
def replay_document(spark: SparkSession, d: str) -> DataFrame:
    events = W.classify_events(_unified(spark, d, "live").withColumnRenamed("timestamp", "event_time"))
    bad = F.when(F.col("source") == "SRC-2", F.lit("soon")).otherwise(F.col("event_time"))
    docs = documents.replay_document(events.withColumn("event_time", bad), F.lit(AS_OF).cast("timestamp"))
    return _texts(documents.flatten_document(docs))


@query
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return _texts(ranking.keep_one(_processed(spark, d), "event_id", ["processed_at"], "first"))


@query
def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return _texts(ranking.keep_one(_processed(spark, d), "event_id", ["processed_at"], "last"))


@query
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """First reports are stored; the second ones lack a field, whose old value stays."""
    processed = _processed(spark, d)
    late = F.col("processed_at") > ts.parse_iso(F.col("event_time")) + F.make_dt_interval(secs=F.lit(30).cast("decimal(18,6)"))
    merged = docstore.upsert(
        processed.filter(~late), processed.filter(late).drop(UPSERT_OMITS), "event_id", ["processed_at"]
    )
    return _texts(merged)


@query
def upsert_stats(spark: SparkSession, d: str) -> DataFrame:
    """What storing all reports does to a store that holds those of one half."""
    processed = documents.to_document(_processed(spark, d))
    batch = processed.withColumn("_id", F.when(F.col("source") != "SRC-4", F.col("_id")))
    return docstore.upsert_report(processed.filter(F.col("event_time") < F.lit(AS_OF).cast("timestamp")), batch, "_id")


@query
def exclude_loaded(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored(spark, d)
    loaded = stored.filter(F.col("event_time") < F.lit(AS_OF).cast("timestamp"))
    return _texts(search.not_loaded(stored, loaded))


@query
def exclude_by_filter(spark: SparkSession, d: str) -> DataFrame:
    """The same through the stored keys and their Bloom filters."""
    stored = _stored(spark, d)
    ids = KeySet(spark, fresh_folder(spark, "keys"))
    loaded = stored.filter(F.col("event_time") < F.lit(AS_OF).cast("timestamp")).select("event_id")
    ids.add(staged(loaded, "loaded"), "event_id")
    with scratch(spark, "exclude") as area:
        return staged(_texts(ids.unseen(stored, "event_id", area)), "unseen")


@query
def collection_stats(spark: SparkSession, d: str) -> DataFrame:
    return analytics.collection_stats(_stored(spark, d)).withColumn("levels", F.array_join("levels", ","))


@query
def extract_since(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.since(_stored(spark, d), AS_OF))


# --- searches over stored documents -----------------------------------------------------------


@query
def recent_events(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.recent_events(_stored(spark, d), 50))


@query
def recent_by_type(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.recent_events(_stored(spark, d), 50, "flood"))


@query
def search_paged(spark: SparkSession, d: str) -> DataFrame:
    return _texts(
        search.search_page(
            _stored(spark, d), page=3, page_size=25, **_PAGED
        )
    )


_PAGED = dict(event_type="fire", severity="MEDIUM", date_from="2024-01-05 00:00:00", date_to="2024-01-20 00:00:00")


@query
def search_paged_empty(spark: SparkSession, d: str) -> DataFrame:
    stored = _stored(spark, d)
    page = search.search_page(stored, page=10**4, page_size=25, **_PAGED)
    return search.page_total(stored, 25, **_PAGED).withColumn("rows_on_page", page.agg(F.count("*")).scalar())


@query
def by_location(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.by_location(_stored(spark, d), *BOX, limit=100))


@query
def by_polygon(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.by_polygon(_stored(spark, d), geo.box_corners(*GEODESIC_BOX), limit=100))


@query
def polygon_events(spark: SparkSession, d: str) -> DataFrame:
    return search.polygon_events(_star(spark, d), geo.box_corners(*GEODESIC_BOX), *RANGE).select(
        "event_id", "latitude", "longitude", "severity_level"
    )


@query
def new_since(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.new_since(_stored(spark, d), AS_OF))


@query
def live_window(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.live_window(_stored(spark, d), AS_OF))


@query
def live_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return _texts(search.live_snapshot(_stored(spark, d), AS_OF, 40))


# --- feeds -----------------------------------------------------------------------------------------


def _publishable(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = quality.split_valid(_unified(spark, d), "publish")
    return valid.drop("processed_at")


@query
def merge_sorted(spark: SparkSession, d: str) -> DataFrame:
    return _publishable(spark, d).orderBy("timestamp", "event_id", "severity_raw")


@query
def route_topics(spark: SparkSession, d: str) -> DataFrame:
    messages = sinks.topic_messages(_publishable(spark, d))
    back = readers.parse_messages(messages.select("value", "topic", "key"))
    # the message value is read back, so both directions are checked
    counted = messages.groupBy("topic").agg(F.count("*").alias("messages"), F.countDistinct("key").alias("keys"))
    sums = back.groupBy(F.concat(F.col("event_type"), F.lit("s-topic")).alias("topic")).agg(
        F.sum("latitude").alias("lat_sum"), F.max("timestamp").alias("last")
    )
    return counted.join(sums, "topic")


@query
def sample_per_type(spark: SparkSession, d: str) -> DataFrame:
    return ranking.sample_per_topic(_unified(spark, d, "live"))


# --- fires and floods -------------------------------------------------------------------------------


@query
def fire_clusters_modis(spark: SparkSession, d: str) -> DataFrame:
    return fires.cluster_fires(_pixels(spark, d, fires.MODIS), fires.MODIS)


@query
def fire_clusters_viirs(spark: SparkSession, d: str) -> DataFrame:
    return fires.cluster_fires(_pixels(spark, d, fires.VIIRS), fires.VIIRS)


@query
def fires_from_csv(spark: SparkSession, d: str) -> DataFrame:
    """File to fire events in one call; pixels that do not parse are left out."""
    path = _pixel_file(spark, d, fires.MODIS, schemas.MODIS_PIXEL_TEXT.fieldNames())
    return fires.fires_from_text(readers.modis_text(spark, path), fires.MODIS, F.col("version").cast("long"))


@query
def fire_rejects(spark: SparkSession, d: str) -> DataFrame:
    path = _pixel_file(spark, d, fires.MODIS, schemas.MODIS_PIXEL_TEXT.fieldNames())
    pixels = fires.parse_pixels(readers.modis_text(spark, path), fires.MODIS)
    nowhere = F.when(F.col("version").cast("long") % 59 != 0, F.col("longitude"))
    rejects = fires.fire_rejects(pixels.withColumn("longitude", nowhere))
    return rejects.groupBy("reason").agg(F.count("*").alias("row_count"))


@query
def fires_union(spark: SparkSession, d: str) -> DataFrame:
    return fires.union_sensors(fire_clusters_modis(spark, d), fire_clusters_viirs(spark, d))


@query
def hull_area(spark: SparkSession, d: str) -> DataFrame:
    return hull.hull_area(_marks(spark, d), ["event_id"], "latitude_dd", "longitude_dd")


@query
def flood_fmi(spark: SparkSession, d: str) -> DataFrame:
    return floods.flood_events(_marks(spark, d))


@query
def flood_rejects(spark: SparkSession, d: str) -> DataFrame:
    rejects = floods.flood_rejects(lift(spark, d, "hwm_dirty"))
    return rejects.groupBy("reason").agg(F.count("*").alias("row_count"))


@query
def flood_marks_used(spark: SparkSession, d: str) -> DataFrame:
    """Floods out of marks of which some lack a position or a quality."""
    missing = lambda c, n: F.when(F.col("row_no") % n != 0, F.col(c))
    faults = {"latitude_dd": missing("latitude_dd", 71), "hwm_quality_id": missing("hwm_quality_id", 73)}
    marks = _marks(spark, d).withColumns(faults)
    return floods.flood_events(marks).select("flood_event_id", "hwm_count", "quality")


# --- places -------------------------------------------------------------------------------------------


@query
def nearest_city(spark: SparkSession, d: str) -> DataFrame:
    return places.nearest_city(lift(spark, d, "live"), lift(spark, d, "gaz"))


@query
def nearest_city_fine(spark: SparkSession, d: str) -> DataFrame:
    """As nearest_city, at positions that are no multiples of a power of two."""
    return places.nearest_city(lift(spark, d, "live_fine"), lift(spark, d, "gaz"))


@query
def hex_counts_fine(spark: SparkSession, d: str) -> DataFrame:
    """Events per hexagon, at positions that are no multiples of a power of two."""
    cell = geo.hex_cell(F.col("latitude"), F.col("longitude"), geo.hex_edge_degrees(4))
    inside = lift(spark, d, "live_fine").filter(geo.in_box(F.col("latitude"), F.col("longitude"), *BOX))
    return inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("event_count")).select(
        F.col("cell.q").cast("long").alias("q"), F.col("cell.r").cast("long").alias("r"), "event_count"
    )


@query
def classify_location(spark: SparkSession, d: str) -> DataFrame:
    return places.classify_points(lift(spark, d, "live"), lift(spark, d, "gaz"))


@query
def hemisphere(spark: SparkSession, d: str) -> DataFrame:
    label = geo.hemisphere(F.col("latitude"), F.col("longitude"))
    return lift(spark, d, "live").groupBy(label.alias("hemisphere")).agg(F.count("*").alias("row_count"))


# --- star schema -----------------------------------------------------------------------------------------


@query
def star_wide(spark: SparkSession, d: str) -> DataFrame:
    hist = _hist(spark, d)
    placed = hist.join(places.classify_points(hist, lift(spark, d, "gaz")), ["latitude", "longitude"])
    return _texts(S.decompose(placed))


@query
def dim_event_type_build(spark: SparkSession, d: str) -> DataFrame:
    return S.event_type_rows(S.decompose(_hist(spark, d))).select("event_type_name")


@query
def dim_time_build(spark: SparkSession, d: str) -> DataFrame:
    return _texts(S.time_rows(S.decompose(_hist(spark, d))))


@query
def dim_location_build(spark: SparkSession, d: str) -> DataFrame:
    return S.location_rows(S.decompose(_hist(spark, d)), lift(spark, d, "gaz"))


@query
def fact_build(spark: SparkSession, d: str) -> DataFrame:
    return S.fact_rows(S.decompose(_hist(spark, d))).drop("country", "region")


@query
def dim_event_type_new(spark: SparkSession, d: str) -> DataFrame:
    """A load meets two types that have no number yet, a later one meets one of them again."""
    store = W.Warehouse(spark, fresh_folder(spark, "types"))
    events = _hist(spark, d)
    kind = F.when(F.col("source") == "SRC-P", F.lit("volcano")).otherwise(F.col("event_type"))
    store.load(events.filter("source <> 'SRC-F'").withColumn("event_type", kind))
    store.load(events.filter("source = 'SRC-F'").withColumn("event_type", F.when(F.col("event_hour") == 3, "drought").otherwise(kind)))
    return analytics.event_counts(store.open())


@query
def star_join(spark: SparkSession, d: str) -> DataFrame:
    star = _star(spark, d)
    joined = star.with_dimensions(star.fact, location=True, time=True, event_type=True)
    return _texts(
        joined.select(
            "event_id", "event_type", "severity_level", "latitude", "longitude", "country", "region", "date", "hour", "source"
        )
    )


@query
def star_load_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Rows per table after a first load, a load of everything, and the same load again."""
    store = W.Warehouse(spark, fresh_folder(spark, "reload"))
    events = _hist(spark, d)
    cities = staged(places.cell_candidates(lift(spark, d, "gaz")), "cities")
    early = events.filter(F.col("event_time") < F.lit("1998-01-01").cast("timestamp"))
    counts = []
    for step, batch in enumerate((early, events, events), start=1):
        store.load(batch, cities)
        star = store.open()
        tables = {"fact": star.fact, "location": star.location, "time": star.time, "event_type": star.event_type}
        counts += [
            staged(
                table.agg(F.lit(step).alias("load_no"), F.lit(name).alias("table_name"), F.count("*").alias("row_count")),
                "counts",
            )
            for name, table in tables.items()
        ]
    return reduce(DataFrame.unionByName, counts)


@query
def load_stats(spark: SparkSession, d: str) -> DataFrame:
    events = W.classify_events(lift(spark, d, "live_dirty"))
    loaded = _stored(spark, d).filter(F.col("event_time") < F.lit(AS_OF).cast("timestamp"))
    return W.load_report(events, loaded)


@query
def event_counts(spark: SparkSession, d: str) -> DataFrame:
    return analytics.event_counts(_star(spark, d))


@query
def event_counts_total(spark: SparkSession, d: str) -> DataFrame:
    return analytics.event_counts_with_total(_star(spark, d))


@query
def monthly_trends(spark: SparkSession, d: str) -> DataFrame:
    return analytics.monthly_trends(_star(spark, d))


@query
def monthly_trends_filtered(spark: SparkSession, d: str) -> DataFrame:
    return analytics.monthly_trends(_star(spark, d), "fire", 1998, "1998-02-10", "1998-11-20", "jAPAN")


@query
def top_locations(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top_locations(_star(spark, d), 20)


@query
def top_locations_by_type(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top_locations(_star(spark, d), 10, "storm")


@query
def event_summary(spark: SparkSession, d: str) -> DataFrame:
    return analytics.event_summary(_star(spark, d))


@query
def event_summary_filtered(spark: SparkSession, d: str) -> DataFrame:
    return analytics.event_summary(_star(spark, d), *RANGE, ["earthquake", "flood"], "india")


@query
def year_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return analytics.year_type_counts(_star(spark, d))


@query
def interp_targets(spark: SparkSession, d: str) -> DataFrame:
    # the history is spread over the anchor years and beyond
    counted = year_type_counts(spark, d).withColumn("year", ((F.col("year") - 1996) * 9 + 1978).cast("int"))
    return counted.withColumn("target", analytics.yearly_target(F.col("event_type"), F.col("year")))


def _half_target() -> Column:
    return F.ceil(analytics.yearly_target(F.col("event_type"), F.col("year")) * F.lit(0.5).cast("double"))


@query
def stratified_cap(spark: SparkSession, d: str) -> DataFrame:
    star = _star(spark, d)
    named = star.with_type_name(star.fact).select("event_id", "event_type", "year", "severity_level")
    return ranking.stratified_cap(named, ["year", "event_type"], _half_target())


# --- searches and maps over the star schema -------------------------------------------------------------------


@query
def search_events(spark: SparkSession, d: str) -> DataFrame:
    return search.search_events(
        _star(spark, d),
        limit=60,
        offset=40,
        start_date=RANGE[0],
        end_date=RANGE[1],
        event_types=["fire", "storm"],
        region="asia",
    )


@query
def search_total(spark: SparkSession, d: str) -> DataFrame:
    return search.matching_total(_star(spark, d), start_date=RANGE[0], end_date=RANGE[1], event_types=["fire", "storm"])


@query
def bbox_events(spark: SparkSession, d: str) -> DataFrame:
    inside = geo.in_box(F.col("latitude"), F.col("longitude"), *BOX)
    return _texts(lift(spark, d, "hist").filter(inside).select("event_id", "latitude", "longitude", "event_date"))


@query
def proximity_search(spark: SparkSession, d: str) -> DataFrame:
    lat, lng, km = CENTER
    return search.search_events(_star(spark, d), limit=200, lat=lat, lng=lng, proximity_km=km)


@query
def search_after(spark: SparkSession, d: str) -> DataFrame:
    """The third page of 50 fires, by the last row of the second."""
    star = _star(spark, d)
    last = search.search_events(star, limit=1, offset=99, event_types=["fire"]).first()
    return search.search_after(star, last["event_time"], last["event_id"], 50, event_types=["fire"])


@query
def search_empty_page(spark: SparkSession, d: str) -> DataFrame:
    """A page past the end: no rows, and the total all the same."""
    filters = dict(start_date=RANGE[0], end_date=RANGE[1], event_types=["fire", "storm"], region="asia")
    page = search.search_after(_star(spark, d), "0001-01-01 00:00:00", "", 50, **filters)
    return search.matching_total(_star(spark, d), **filters).withColumn("rows_on_page", page.agg(F.count("*")).scalar())


@query
def map_grid(spark: SparkSession, d: str) -> DataFrame:
    return mapview.map_grid(_star(spark, d), WORLD, 4, *FULL_RANGE)


@query
def map_hex(spark: SparkSession, d: str) -> DataFrame:
    return mapview.map_hex(_star(spark, d), WORLD, 2, *RANGE, min_count=3, cap=20)


@query
def map_points(spark: SparkSession, d: str) -> DataFrame:
    return mapview.map_points(_star(spark, d), BOX, *RANGE)


@query
def map_view(spark: SparkSession, d: str) -> DataFrame:
    min_lat, max_lat, min_lon, max_lon = BOX
    return mapview.map_view(_star(spark, d), min_lat, max_lat, min_lon, max_lon, 6, *FULL_RANGE)


@query
def map_total(spark: SparkSession, d: str) -> DataFrame:
    """Totals beside clusters, beside points, and of a box without events."""
    star = _star(spark, d)
    nowhere = (-89.5, -89.0, 10.0, 11.0)
    totals = [mapview.map_total(star, box, *RANGE, zoom) for box, zoom in ((BOX, 4), (BOX, 12), (nowhere, 9))]
    return reduce(DataFrame.unionByName, [t.withColumn("map_no", F.lit(n)) for n, t in enumerate(totals, start=1)])


# --- streams ------------------------------------------------------------------------------------------------------


def _live_stream(spark: SparkSession, d: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return lift_stream(readers.table_stream(spark, d, "events"))


def _unified_stream(spark: SparkSession, d: str) -> DataFrame:
    stream = _live_stream(spark, d)
    return stream.withColumn("timestamp", ts.iso_text(F.col("event_time"))).drop("event_time")


def _processed_stream(spark: SparkSession, d: str) -> DataFrame:
    stream = _unified_stream(spark, d)
    at = ts.parse_iso(F.col("timestamp")) + F.expr("INTERVAL '3' SECOND")
    return jobs.process(stream, "cm", "drop", processed_at=at)


def _paths(spark: SparkSession, purpose: str) -> tuple[str, str]:
    base = fresh_folder(spark, purpose)
    return f"{base}/data", f"{base}/checkpoint"


def _drained(spark: SparkSession, stream: DataFrame, purpose: str) -> DataFrame:
    path, checkpoint = _paths(spark, purpose)
    jobs.append_files(stream, path, checkpoint, availableNow=True).awaitTermination()
    return _texts(spark.read.schema(stream.schema).parquet(path))


@query
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    messages = sinks.topic_messages(_unified_stream(spark, d).select(*schemas.UNIFIED_EVENT.fieldNames()))
    return _drained(spark, jobs.ingest(messages), "ingest")


@query
def stream_process(spark: SparkSession, d: str) -> DataFrame:
    return _drained(spark, _processed_stream(spark, d), "process")


@query
def stream_critical(spark: SparkSession, d: str) -> DataFrame:
    processed = _processed_stream(spark, d)
    path, checkpoint = _paths(spark, "critical")
    jobs.critical_alerts(processed, path, checkpoint, availableNow=True).awaitTermination()
    return _texts(spark.read.schema(processed.schema).parquet(path))


@query
def stream_route(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = _paths(spark, "route")
    events = _unified_stream(spark, d).select(*schemas.UNIFIED_EVENT.fieldNames())
    jobs.route_by_type(events, path, checkpoint, availableNow=True).awaitTermination()
    routed = spark.read.schema("key string, value string, topic string").parquet(path)
    return routed.groupBy("topic").agg(F.count("*").alias("messages"))


@query
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = _paths(spark, "counts")
    jobs.running_counts(_processed_stream(spark, d), path, checkpoint, availableNow=True).awaitTermination()
    return jobs.read_counts(spark, path)


@query
def stream_stats(spark: SparkSession, d: str) -> DataFrame:
    """One source sends no readings."""
    events = _unified_stream(spark, d).withColumn("severity_raw", F.when(F.col("source") != "SRC-4", F.col("severity_raw")))
    path, checkpoint = _paths(spark, "stats")
    jobs.running_stats(events, path, checkpoint, "cm", availableNow=True).awaitTermination()
    return jobs.read_stats(spark, path)


@query
def stream_live_window(spark: SparkSession, d: str) -> DataFrame:
    drained = _live_stream(spark, d)
    path, checkpoint = _paths(spark, "live")
    jobs.append_files(jobs.live_events(drained), path, checkpoint, availableNow=True).awaitTermination()
    kept = spark.read.schema(drained.schema).parquet(path)
    return _texts(search.live_window(kept, AS_OF))


@query
def stream_new_events(spark: SparkSession, d: str) -> DataFrame:
    """A second query follows the table the first one writes."""
    processed = _processed_stream(spark, d)
    path, checkpoint = _paths(spark, "follow")
    jobs.append_files(processed, path, checkpoint, availableNow=True).awaitTermination()
    stored = readers.file_stream(spark, path, processed.schema, "parquet")
    return _drained(spark, jobs.new_events(stored, AS_OF), "new")


@query
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Two streams write one store, one after the other; a later batch lacks a field."""
    processed = _processed_stream(spark, d)
    schema = documents.to_document(processed).schema
    base = fresh_folder(spark, "upsert")
    for left_out in ("SRC-0", "SRC-1"):
        jobs.upsert_documents(
            processed.filter(F.col("source") != left_out), f"{base}/store", f"{base}/checkpoint-{left_out}", ["processed_at"], availableNow=True
        ).awaitTermination()
    late = documents.to_document(_processed(spark, d)).filter(
        F.col("processed_at") > F.col("event_time") + F.expr("INTERVAL '30' SECOND")
    )
    docstore.write_batch(late.drop(UPSERT_OMITS), f"{base}/store", schema, ["processed_at"])
    return _texts(documents.flatten_document(docstore.read_documents(spark, f"{base}/store", schema)))
