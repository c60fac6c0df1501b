"""The batch job from classified events to a stored star schema.

Loading is idempotent: an event id that is stored is skipped, a natural key that
has a dimension row gets no second one.  Dimensions are appended before facts,
so a load that dies half way leaves no fact without its dimensions, and running
it again completes it.  Counts per year, type and level and the map's cells
are kept beside the facts; a log says which loads ended, and what an unended load
may have left wrong is neither read nor kept: the next load counts the facts anew.

The ids of events and places are also kept as :class:`KeySet`s, whose Bloom
filters tell a load which of its ids may be stored: a load of new events reads no
stored id.  A load that never ended may have left them short of its facts, so the
next one builds them anew from the tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry import schemas
from hazardry.functions import severity
from hazardry.functions.predicates import all_of
from hazardry.operators import mapview
from hazardry.operators import star as S
from hazardry.operators.places import cell_candidates
from hazardry.operators.ranking import keep_one
from hazardry.plans.keyset import KeySet
from hazardry.sources.readers import existing
from hazardry.sources.workspace import range_tasks, scratch

TABLES = {
    "fact": schemas.FACT_EVENT,
    "event_type": schemas.DIM_EVENT_TYPE,
    "location": schemas.DIM_LOCATION,
    "time": schemas.DIM_TIME,
    "counts": schemas.EVENT_COUNTS,
    "pyramid": schemas.MAP_PYRAMID,
    "log": schemas.LOAD_LOG,
}


def classify_events(
    events: DataFrame, profile: str = "cm", below_min: str = "drop"
) -> DataFrame:
    """Events with a ``severity_level``; those without a level, or of a type without thresholds, are left out."""
    kind, reading = F.col("event_type"), F.col("severity_raw")
    known = reading.isNotNull() & ~F.isnan(reading)
    kept = events.filter(known)
    if below_min == "drop":
        kept = kept.filter(severity.reaches_minimum(kind, reading, profile))
    return kept.withColumn(
        "severity_level", severity.severity_level(kind, reading, profile, below_min)
    ).filter(kind.isin(*C.EVENT_TYPES))


def loadable(classified: DataFrame) -> Column:
    """Whether a row can become a fact: it has every value that keys need, and its position is a number."""
    needed = ("event_id", "event_type", "severity_level", "event_time")
    numbers = [F.nanvl(c, F.lit(None)).isNotNull() for c in ("latitude", "longitude")]
    return all_of([*[F.col(c).isNotNull() for c in needed], *numbers])


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables below one folder; the fact table is partitioned by year."""

    spark: SparkSession
    path: str

    def _table(self, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not existing(self.spark, [path]):
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(path)

    def _types(self) -> dict[str, int]:
        return {r["event_type_name"]: r["event_type_id"] for r in self._table("event_type").collect()}

    def open(self) -> S.Star:
        """The star as it is now.  Counts of a load that never ended are not used."""
        return self._star(self._unfinished())

    def _star(self, unfinished: list[str]) -> S.Star:
        tables = [self._table(n) for n in ("fact", "event_type", "location", "time")]
        counts = None if unfinished else self._table("counts")
        pyramid = None if unfinished else self._table("pyramid")
        return S.Star(*tables, counts, S.numbered_types(self._types(), []), pyramid)

    def _unfinished(self) -> list[str]:
        """Loads that began and did not end."""
        begun = self._table("log").groupBy("load_id").agg(F.count_if(F.col("state") == "done").alias("done"))
        return [r["load_id"] for r in begun.filter("done = 0").collect()]

    def _log(self, state: str, *load_ids: str) -> None:
        self._append(self.spark.createDataFrame([(i, state) for i in load_ids], TABLES["log"]).coalesce(1), "log")

    def keys(self, table: str) -> KeySet:
        """The stored ids of `fact` or `location`."""
        return KeySet(self.spark, f"{self.path}/keys_{table}")

    def load(
        self, classified: DataFrame, gazetteer: DataFrame | None = None, order: list[str] | None = None
    ) -> dict[str, int]:
        """Append what is new; counts received, inserted, skipped (duplicate) and failed rows.

        ``classified`` has event_id, event_type, severity_level, latitude,
        longitude, event_time and source.  Of several rows with one new id the
        first in ``order`` (event_time unless given) is kept.  Rows that are not
        :func:`loadable` are left out.  A type that was never met gets a number.
        """
        broken = self._unfinished()
        stored = self._star(broken)
        known = {r["event_type_name"] for r in stored.event_type.collect()}
        load_id = uuid.uuid4().hex
        self._log("begun", load_id)
        seen = Observation(f"load-{load_id}")
        watched = classified.observe(
            seen, F.count(F.lit(1)).alias("received"), F.count_if(~loadable(classified)).alias("errors")
        )
        event_ids, place_ids = self.keys("fact"), self.keys("location")
        for table, key, ids in (("fact", "event_id", event_ids), ("location", "location_id", place_ids)):
            if broken or existing(self.spark, [f"{self.path}/{table}"]) and not ids.exists():
                ids.rebuild(self._table(table).select(key).distinct(), key)
        with scratch(self.spark, "load") as area:
            first = area.staged(keep_one(watched.filter(loadable(classified)), "event_id", order or ["event_time"]))
            unseen = event_ids.unseen(first, "event_id", area)
            fresh = S.decompose(first) if unseen is first else area.staged(S.decompose(unseen))
            inserted = fresh.count()
            points = fresh.select("latitude", "longitude").distinct()
            if gazetteer is not None and "blocks" not in gazetteer.columns:
                gazetteer = area.staged(cell_candidates(gazetteer))
            places = area.staged(S.location_rows(points, gazetteer))
            names = [r[0] for r in fresh.select("event_type_name").distinct().collect()]
            types = S.numbered_types(stored.types, names)

            kinds = [(types[name], name) for name in sorted(set(names) - known)]
            hours = S.not_yet_in(S.time_rows(fresh), stored.time, "time_id")
            if kinds:
                self._append(self.spark.createDataFrame(kinds, TABLES["event_type"]).coalesce(1), "event_type")
            self._append(hours, "time")
            # neighbouring places share row groups, so a box reads few of them
            new_places = place_ids.unseen(places, "location_id", area)
            if new_places is not places:
                new_places = area.staged(new_places)
            position = ["latitude", "longitude"]
            self._append(
                new_places.repartitionByRange(*range_tasks(new_places.count()), *position).sortWithinPartitions(*position),
                "location",
            )
            place_ids.add(new_places, "location_id")
            # written once: the range partitioning reads its input twice
            facts = area.staged(S.fact_rows(S.with_places(fresh, places), types))
            # a task holds a month or a part of one, in order of place: date ranges skip
            # files, boxes skip row groups, and few files are written
            month = F.expr("time_id div 10000")
            self._append(
                facts.repartitionByRange(*range_tasks(inserted), month, "cell_id", "event_id").sortWithinPartitions(month, "cell_id"),
                "fact",
                "year",
            )
            event_ids.add(facts, "event_id")
            self._append(S.counts_of(facts).coalesce(1), "counts")
            self._append(self._cells(facts), "pyramid", "kind", "zoom")
        if broken:
            recounted = S.counts_of(self._table("fact"))
            recounted.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts")
            self._cells(self._table("fact")).write.mode("overwrite").partitionBy("kind", "zoom").parquet(f"{self.path}/pyramid")
        self._log("done", load_id, *broken)
        counted = seen.get
        return {
            "received": counted["received"],
            "inserted": inserted,
            "skipped": counted["received"] - counted["errors"] - inserted,
            "errors": counted["errors"],
        }

    @staticmethod
    def _cells(facts: DataFrame) -> DataFrame:
        """The map's sums of facts, in the order that months and boxes are asked for."""
        order = ["kind", "zoom", "month", "cell_lat", "cell_lon"]
        return mapview.pyramid_rows(facts, range_tasks(facts.count())).sortWithinPartitions(*order)

    def _append(self, rows: DataFrame, name: str, *partition_by: str) -> None:
        columns = TABLES[name].fieldNames()
        rows.select(*columns).write.mode("append").partitionBy(*partition_by).parquet(
            f"{self.path}/{name}"
        )


def load_report(classified: DataFrame, loaded_ids: DataFrame) -> DataFrame:
    """What a load of ``classified`` would do: one row of counts and the load rate in percent."""
    sound = classified.filter(loadable(classified)).select("event_id").distinct()
    fresh = S.not_yet_in(sound, loaded_ids, "event_id")
    counted = classified.agg(
        F.count("*").alias("total_events"), F.count_if(~loadable(classified)).alias("errors")
    )
    total, errors = F.col("total_events"), F.col("errors")
    inserted = F.col("facts_inserted")
    return counted.withColumn("facts_inserted", fresh.agg(F.count("*")).scalar()).select(
        "total_events",
        "facts_inserted",
        (total - errors - inserted).alias("facts_skipped"),
        "errors",
        F.when(total > 0, inserted.cast("double") / total * 100).alias("load_rate"),
    )
