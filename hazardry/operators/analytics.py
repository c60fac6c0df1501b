"""Counts, trends and rankings over the star schema.

Facts carry what these queries filter and group by, so each is one aggregation,
combined on the map side: a place or type with a third of all facts costs no more
than any other.  Questions about whole years by type and level are answered from
the counts kept on load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions.predicates import all_of, same_text
from hazardry.functions.severity import severity_level
from hazardry.functions.timestamps import month_name
from hazardry.operators.star import Star


def _count() -> Column:
    return F.count("*").alias("event_count")


def _sum() -> Column:
    return F.sum("event_count").alias("event_count")


def _in_country(facts: DataFrame, country: str | None) -> DataFrame:
    wanted = same_text(F.col("country"), country)
    return facts if wanted is None else facts.filter(wanted)


def event_counts(star: Star) -> DataFrame:
    """event_type, event_count; most frequent first."""
    counted = star.counted().groupBy("event_type_id").agg(_sum())
    named = star.with_type_name(counted)
    return named.select("event_type", "event_count").orderBy(F.desc("event_count"), "event_type")


def event_counts_with_total(star: Star) -> DataFrame:
    """As :func:`event_counts`, plus a row ``TOTAL`` from the same pass."""
    counted = star.with_type_name(star.counted())
    return (
        counted.rollup("event_type")
        .agg(F.grouping("event_type").alias("_total"), _sum())
        .select(
            F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("event_type")).alias("event_type"),
            "event_count",
        )
    )


def monthly_trends(
    star: Star,
    event_type: str | None = None,
    year: int | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    country: str | None = None,
) -> DataFrame:
    """year, month, month_name, event_count in order of time."""
    facts = star.facts(start_date, end_date, [event_type] if event_type else None)
    if year is not None:
        facts = facts.filter(F.col("year") == year)
    month = F.expr("cast(time_id div 10000 % 100 as int)")
    return (
        _in_country(facts, country)
        .groupBy("year", month.alias("month"))
        .agg(_count())
        .select("year", "month", month_name(F.col("year"), F.col("month")).alias("month_name"), "event_count")
        .orderBy("year", "month")
    )


def top_locations(star: Star, limit: int = 10, event_type: str | None = None) -> DataFrame:
    """country, region, event_count of the busiest regions; ties by name."""
    facts = star.facts(event_types=[event_type] if event_type else None)
    return (
        facts.groupBy("country", "region")
        .agg(_count())
        .orderBy(F.desc("event_count"), "country", "region")
        .limit(limit)
    )


def event_summary(
    star: Star,
    start_date: str | None = None,
    end_date: str | None = None,
    event_types: list[str] | None = None,
    country: str | None = None,
) -> DataFrame:
    """dimension, label, event_count: per type, per severity and in total, in one pass."""
    if country:
        facts = _in_country(star.facts(start_date, end_date, event_types), country)
        counted = facts.groupBy("event_type_id", "severity_level").agg(_count())
    else:
        counted = star.counted(start_date, end_date, event_types)
    return summarise_counts(star.with_type_name(counted))


def summarise_counts(counted: DataFrame) -> DataFrame:
    """Marginals of (event_type, severity_level, event_count) by grouping sets; a total also of nothing."""
    nothing = counted.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("string").alias("severity_level"),
        F.lit(0).cast("long").alias("event_count"),
    )
    grouped = counted.select(*nothing.columns).unionByName(nothing).groupingSets(
        [("event_type",), ("severity_level",), ()], "event_type", "severity_level"
    ).agg(
        F.grouping("event_type").alias("_no_type"),
        F.grouping("severity_level").alias("_no_level"),
        F.sum("event_count").alias("event_count"),
    )
    by_type, by_level = F.col("_no_type") == 0, F.col("_no_level") == 0
    grouped = grouped.filter((F.col("event_count") > 0) | ~(by_type | by_level))
    return grouped.select(
        F.when(by_type, "type").when(by_level, "severity").otherwise("total").alias("dimension"),
        F.when(by_type, F.col("event_type"))
        .when(by_level, F.col("severity_level"))
        .otherwise("all")
        .alias("label"),
        "event_count",
    )


def year_type_counts(star: Star) -> DataFrame:
    """year, event_type, event_count."""
    counted = star.counted().groupBy("year", "event_type_id").agg(_sum())
    return (
        star.with_type_name(counted)
        .select("year", "event_type", "event_count")
        .orderBy("year", "event_type")
    )


def severity_summary(events: DataFrame) -> DataFrame:
    """Per type and for TOTAL: event_count, minimum, maximum, mean and number of zeros."""
    return (
        events.rollup("event_type")
        .agg(
            F.grouping("event_type").alias("_total"),
            _count(),
            F.min("severity_raw").alias("min_severity"),
            F.max("severity_raw").alias("max_severity"),
            F.avg("severity_raw").alias("mean_severity"),
            F.count_if(F.col("severity_raw") == 0.0).alias("zero_count"),
        )
        .select(
            F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("event_type")).alias("event_type"),
            "event_count",
            "min_severity",
            "max_severity",
            "mean_severity",
            "zero_count",
        )
    )


def severity_distribution(events: DataFrame, profile: str = "fmi") -> DataFrame:
    """Rows per level, DROP among them."""
    level = severity_level(F.col("event_type"), F.col("severity_raw"), profile, "label")
    return events.groupBy(level.alias("severity_level")).agg(_count())


def collection_stats(documents: DataFrame) -> DataFrame:
    """Per type: event_count and the sorted set of levels present."""
    return (
        documents.groupBy("event_type")
        .agg(_count(), F.array_sort(F.collect_set("severity_level")).alias("levels"))
        .orderBy("event_type")
    )


def yearly_target(event_type: Column, year: Column) -> Column:
    """Target of a type in a year: linear between anchor years, level outside, ties to even."""
    chain = None
    for kind, anchors in C.YEARLY_TARGETS.items():
        points = sorted(anchors.items())
        target = F.when(year <= points[0][0], F.lit(float(points[0][1])))
        for (y0, v0), (y1, v1) in zip(points, points[1:]):
            share = (year - y0) / F.lit(float(y1 - y0))
            target = target.when(year <= y1, share * float(v1 - v0) + float(v0))
        target = F.bround(target.otherwise(F.lit(float(points[-1][1])))).cast("int")
        is_kind = event_type == kind
        chain = F.when(is_kind, target) if chain is None else chain.when(is_kind, target)
    return chain
