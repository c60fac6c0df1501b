"""Star schema: dimension and fact rows from classified events.

Keys are functions of the natural key, so facts need no lookup join and every
task, retry and rerun gives the same key:

* ``time_id``      the integer yyyymmddhh; ordered, so a date range becomes a
                   key range that is pushed into the fact scan;
* ``location_id``  ``"lat,lon"`` in shortest decimal text; unique by
                   construction (a 64-bit hash would collide among 10^10 points);
* ``event_type_id`` position in the fixed list of types; a type beyond it gets
                   the next number when it is first loaded.

A place is nearly unique to its event, so the location dimension is about as long
as the fact table.  Facts therefore carry their position, country and region as
columns of their own, beside ``cell_id``, the one-degree cell: searches, maps,
rankings and country filters read facts alone.  The dimensions hold the same
values once each, for those who ask for the joined star.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions.predicates import all_of
from hazardry.operators.places import classify_points


FIXED_TYPES = {name: key for key, name in enumerate(C.EVENT_TYPES, start=1)}


def event_type_key(name: Column, types: dict[str, int] = FIXED_TYPES) -> Column:
    return F.try_element_at(_literal_map(types), name)


def event_type_name(key: Column, types: dict[str, int] = FIXED_TYPES) -> Column:
    """Name of a type key.  There are few types, so a constant map spares the join."""
    return F.try_element_at(_literal_map({k: name for name, k in types.items()}), key)


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def numbered_types(known: dict[str, int], names: list[str]) -> dict[str, int]:
    """``known`` and a number for every further name, in order of name."""
    out = FIXED_TYPES | known
    for name in sorted(set(names) - out.keys()):
        out[name] = max(out.values()) + 1
    return out


def time_key(date: Column, hour: Column) -> Column:
    year = F.year(date).cast("long")
    return year * 1000000 + F.month(date) * 10000 + F.dayofmonth(date) * 100 + hour


def location_key(lat: Column, lon: Column) -> Column:
    """-0.0 and 0.0 are the same place, hence the added zero."""
    return F.concat_ws(",", (lat + 0.0).cast("string"), (lon + 0.0).cast("string"))


def decompose(events: DataFrame) -> DataFrame:
    """Classified events (with ``event_time``, a timestamp) to star rows before the split.

    Adds date, day, month, year and hour; country and region are carried if there.
    """
    day = F.to_date("event_time")
    places = [c for c in ("country", "region") if c in events.columns]
    return events.select(
        F.col("event_type").alias("event_type_name"),
        "latitude",
        "longitude",
        *places,
        day.alias("date"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.hour("event_time").alias("hour"),
        "event_id",
        "severity_level",
        F.coalesce("source", F.lit("")).alias("source"),
    )


def event_type_rows(star_rows: DataFrame, types: dict[str, int] = FIXED_TYPES) -> DataFrame:
    return star_rows.select(
        event_type_key(F.col("event_type_name"), types).alias("event_type_id"), "event_type_name"
    ).distinct()


def time_rows(star_rows: DataFrame) -> DataFrame:
    return star_rows.select(
        time_key(F.col("date"), F.col("hour")).alias("time_id"), "date", "day", "month", "year", "hour"
    ).distinct()


def location_rows(star_rows: DataFrame, gazetteer: DataFrame | None) -> DataFrame:
    """One row per distinct point; only distinct points are looked up in the gazetteer.

    A position of -0.0 is that of 0.0.
    """
    star_rows = star_rows.withColumns({c: F.col(c) + 0.0 for c in ("latitude", "longitude")})
    return classify_points(star_rows, gazetteer).select(
        location_key(F.col("latitude"), F.col("longitude")).alias("location_id"),
        "country",
        "region",
        "latitude",
        "longitude",
    )


def with_places(star_rows: DataFrame, places: DataFrame) -> DataFrame:
    """Rows with the country and region of their place, one row per place in ``places``."""
    named = places.select("location_id", "country", "region")
    keyed = star_rows.drop("country", "region").withColumn(
        "location_id", location_key(F.col("latitude"), F.col("longitude"))
    )
    return keyed.join(named, "location_id").drop("location_id")


def fact_rows(star_rows: DataFrame, types: dict[str, int] = FIXED_TYPES) -> DataFrame:
    """Facts; country and region are NULL where the rows have none."""
    place = [
        F.col(c) if c in star_rows.columns else F.lit(None).cast("string").alias(c) for c in ("country", "region")
    ]
    return star_rows.select(
        "event_id",
        event_type_key(F.col("event_type_name"), types).alias("event_type_id"),
        location_key(F.col("latitude"), F.col("longitude")).alias("location_id"),
        time_key(F.col("date"), F.col("hour")).alias("time_id"),
        "severity_level",
        "source",
        F.lit(1).alias("count_metric"),
        geo.degree_cell(F.col("latitude"), F.col("longitude")).alias("cell_id"),
        "latitude",
        "longitude",
        *place,
        "year",
    )


def counts_of(facts: DataFrame) -> DataFrame:
    """Facts per year, type and level: a few hundred rows whatever the number of facts."""
    return facts.groupBy("year", "event_type_id", "severity_level").agg(F.count("*").alias("event_count"))


def not_yet_in(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet; only the key column of the store is read."""
    return candidates.join(existing.select(key), key, "left_anti")


@dataclass(frozen=True)
class Star:
    """The four tables of the schema, the counts and map cells kept beside them and the numbers of the types."""

    fact: DataFrame
    event_type: DataFrame
    location: DataFrame
    time: DataFrame
    counts: DataFrame | None = None
    types: dict[str, int] = field(default_factory=lambda: dict(FIXED_TYPES))
    pyramid: DataFrame | None = None

    def facts(
        self,
        start_date: str | None = None,
        end_date: str | None = None,
        event_types: list[str] | None = None,
        box: tuple | None = None,
    ) -> DataFrame:
        """Facts of a date range, of some types and in a ``box`` (south, north, west, east).

        All of it is pushed into the fact scan: years and key ranges, type keys,
        the one-degree cells that the box touches, and the box itself.
        """
        known = [self.types[t] for t in event_types or [] if t in self.types]
        first, last = date_number(start_date), date_number(end_date)
        clauses = [
            None if first is None else (F.col("time_id") >= first * 100) & (F.col("year") >= first // 10000),
            None if last is None else (F.col("time_id") <= last * 100 + 23) & (F.col("year") <= last // 10000),
            F.col("event_type_id").isin(known) if event_types else None,
            None if box is None else geo.cells_touch_box(F.col("cell_id"), box),
            None if box is None else geo.in_box(F.col("latitude"), F.col("longitude"), *box),
        ]
        predicate = all_of(clauses)
        return self.fact if predicate is None else self.fact.filter(predicate)

    def counted(
        self, start_date: str | None = None, end_date: str | None = None, event_types: list[str] | None = None
    ) -> DataFrame:
        """year, event_type_id, severity_level, event_count of a date range and of some types.

        From the kept counts if the range is made of whole years, else from the facts.
        """
        whole = (start_date or "0000-01-01")[4:10] == "-01-01" and (end_date or "9999-12-31")[4:10] == "-12-31"
        if self.counts is None or not whole:
            return counts_of(self.facts(start_date, end_date, event_types))
        known = [self.types[t] for t in event_types or [] if t in self.types]
        clauses = [
            None if not start_date else F.col("year") >= int(start_date[:4]),
            None if not end_date else F.col("year") <= int(end_date[:4]),
            F.col("event_type_id").isin(known) if event_types else None,
        ]
        predicate = all_of(clauses)
        return self.counts if predicate is None else self.counts.filter(predicate)

    def with_type_name(self, rows: DataFrame) -> DataFrame:
        """``event_type`` beside an ``event_type_id``."""
        return rows.withColumn("event_type", event_type_name(F.col("event_type_id"), self.types))

    def with_dimensions(
        self,
        facts: DataFrame,
        location: bool | DataFrame = False,
        time: bool = False,
        event_type: bool = False,
    ) -> DataFrame:
        """Facts joined with the dimensions asked for and no others.

        Every fact has its dimension rows, so a dimension that adds no column and
        no filter is left out.  ``location`` may be a filtered dimension.
        """
        out = facts
        if location is not False:
            places = self.location if location is True else location
            carried = [c for c in ("latitude", "longitude", "country", "region") if c in places.columns]
            out = out.drop(*carried).join(places, "location_id")
        if time:
            out = out.join(self.time.drop("year"), "time_id")
        if event_type:
            names = self.event_type.withColumnRenamed("event_type_name", "event_type")
            out = out.join(names, "event_type_id")
        return out


def date_number(text: str | None) -> int | None:
    """YYYY-MM-DD as the integer yyyymmdd."""
    return None if not text else int(text[:10].replace("-", ""))
