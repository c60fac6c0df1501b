"""Filtered, sorted and paged reads of stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions.predicates import all_of, at_least, at_most, contains_text, equals, same_text
from hazardry.functions.timestamps import time_key_text
from hazardry.operators.star import Star


def _where(events: DataFrame, *clauses: Column | None) -> DataFrame:
    predicate = all_of(clauses)
    return events if predicate is None else events.filter(predicate)


def _time(value: str | None) -> Column | None:
    """A time without a zone counts as UTC (the session zone)."""
    return None if value is None else F.lit(value).cast("timestamp")


# --- processed events (the document store) ------------------------------------


def recent_events(events: DataFrame, limit: int = 20, event_type: str | None = None) -> DataFrame:
    """The newest events; ties of time by id."""
    return (
        _where(events, equals(F.col("event_type"), event_type))
        .orderBy(F.desc("event_time"), "event_id")
        .limit(limit)
    )


def _searched(
    events: DataFrame,
    event_type: str | None = None,
    severity: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    return _where(
        events,
        equals(F.col("event_type"), event_type),
        equals(F.col("severity_level"), severity),
        at_least(F.col("event_time"), _time(date_from)),
        at_most(F.col("event_time"), _time(date_to)),
    )


def page_total(events: DataFrame, page_size: int = 20, **filters) -> DataFrame:
    """``total`` and ``pages`` of a search in one row, whatever page is asked for."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(page_size))).cast("long")
    return _searched(events, **filters).agg(F.count("*").alias("total")).withColumn("pages", pages)


def search_page(events: DataFrame, page: int = 1, page_size: int = 20, **filters) -> DataFrame:
    """One page, newest first, with ``total`` and ``pages`` of the whole result.

    ``filters`` takes event_type, severity, date_from and date_to.  A page past
    the end has no rows; :func:`page_total` still tells the total.
    """
    totals = page_total(events, page_size, **filters)
    return (
        _searched(events, **filters)
        .orderBy(F.desc("event_time"), "event_id")
        .offset((page - 1) * page_size)
        .limit(page_size)
        .withColumn("total", totals.select("total").scalar())
        .withColumn("pages", totals.select("pages").scalar())
    )


def by_location(
    events: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float, limit: int = 100
) -> DataFrame:
    """Events in a box, in order of id.  Edges are planar and belong to the box."""
    inside = geo.in_box(F.col("latitude"), F.col("longitude"), min_lat, max_lat, min_lon, max_lon)
    return events.filter(inside).orderBy("event_id").limit(limit)


def by_polygon(events: DataFrame, corners: list[tuple[float, float]], limit: int = 100) -> DataFrame:
    """Events in a convex polygon with great-circle edges, in order of id.

    ``corners`` are (latitude, longitude), counter-clockwise; ``geo.box_corners``
    gives those of a box.  See :func:`geo.in_polygon`.
    """
    inside = geo.in_polygon(F.col("latitude"), F.col("longitude"), corners)
    return events.filter(inside).orderBy("event_id").limit(limit)


def polygon_events(star: Star, corners: list[tuple[float, float]], start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Facts in a polygon, from the cells that its box touches."""
    facts = star.facts(start_date, end_date, box=geo.polygon_bounds(corners))
    return facts.filter(geo.in_polygon(F.col("latitude"), F.col("longitude"), corners))


def since(events: DataFrame, start: str | None) -> DataFrame:
    """Events at or after a time (incremental extract)."""
    return _where(events, at_least(F.col("event_time"), _time(start)))


def new_since(events: DataFrame, cursor: str) -> DataFrame:
    """Events processed strictly after the cursor, oldest first."""
    return events.filter(F.col("processed_at") > _time(cursor)).orderBy("processed_at", "event_id")


def live_window(events: DataFrame, as_of: str, hours: int = C.LIVE_WINDOW_HOURS) -> DataFrame:
    """Events that have not expired at ``as_of``: no older than ``hours``, none from the future."""
    end = _time(as_of)
    begin = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return events.filter((F.col("event_time") > begin) & (F.col("event_time") <= end))


def live_snapshot(events: DataFrame, as_of: str, limit: int = 100) -> DataFrame:
    """The newest events of the live window."""
    return recent_events(live_window(events, as_of), limit)


def not_loaded(events: DataFrame, loaded_ids: DataFrame) -> DataFrame:
    """Events whose id is not among those loaded already."""
    return events.join(loaded_ids.select("event_id").distinct(), "event_id", "left_anti")


# --- star schema -----------------------------------------------------------------


def _matching(
    star: Star,
    start_date: str | None = None,
    end_date: str | None = None,
    event_types: list[str] | None = None,
    country: str | None = None,
    region: str | None = None,
    lat: float | None = None,
    lng: float | None = None,
    proximity_km: float = 500.0,
) -> DataFrame:
    """Facts that meet every filter given, from the fact scan alone."""
    box = None if lat is None or lng is None else geo.near_box(lat, lng, proximity_km)
    facts = star.facts(start_date, end_date, event_types, box)
    return _where(facts, same_text(F.col("country"), country), contains_text(F.col("region"), region))


def search_events(star: Star, limit: int = 20, offset: int = 0, **filters) -> DataFrame:
    """One page of the star schema, newest first, with ``total`` of the whole result.

    ``filters`` takes start_date, end_date, event_types, country, region, lat,
    lng and proximity_km.  The order is date and hour descending, then id.  A
    page past the end has no rows; its total is that of :func:`matching_total`.
    Every task holds offset + limit rows, so deep pages are for :func:`search_after`.
    """
    matching = _matching(star, **filters)
    page = matching.orderBy(F.desc("time_id"), F.asc("event_id")).offset(offset).limit(limit)
    return _shown(star, page, matching_total(star, **filters))


def search_after(star: Star, last_time: str, last_id: str, limit: int = 20, **filters) -> DataFrame:
    """The page after the row with this event_time and event_id: as cheap at any depth as the first.

    Columns and order are those of :func:`search_events`.
    """
    matching = _matching(star, **filters)
    key = int("".join(c for c in last_time[:13] if c.isdigit()))
    rest = matching.filter((F.col("time_id") < key) | ((F.col("time_id") == key) & (F.col("event_id") > last_id)))
    page = rest.orderBy(F.desc("time_id"), F.asc("event_id")).limit(limit)
    return _shown(star, page, matching_total(star, **filters))


def _shown(star: Star, page: DataFrame, total: DataFrame) -> DataFrame:
    return star.with_type_name(page).select(
        "event_id",
        "event_type",
        "severity_level",
        "latitude",
        "longitude",
        "country",
        "region",
        time_key_text(F.col("time_id")).alias("event_time"),
        "source",
        total.scalar().alias("total"),
    )


def matching_total(star: Star, **filters) -> DataFrame:
    """``total``, the number of matching facts, in one row whatever page is asked for."""
    return _matching(star, **filters).agg(F.count("*").alias("total"))
