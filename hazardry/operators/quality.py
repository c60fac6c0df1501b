"""Validation gates and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions import timestamps as ts
from hazardry.functions.predicates import all_of
from hazardry.schemas import UNIFIED_EVENT

REQUIRED = UNIFIED_EVENT.fieldNames()


def _range(name: str) -> Column:
    limit = 90.0 if name == "latitude" else 180.0
    return F.col(name).between(-limit, limit)


def _checks(mode: str, required: list[str]) -> dict[str, Column]:
    """Message of every check and the condition that passes it.

    strict   all fields, known type, severity a number, coordinates in range
    publish  all fields, known type, coordinates in range
    process  all fields, known type, severity a number
    """
    if mode not in ("strict", "publish", "process"):
        raise ValueError(f"unknown mode {mode!r}")
    checks = {f"missing {c}": F.col(c).isNotNull() for c in required}
    checks["unknown event_type"] = F.col("event_type").isin(*C.EVENT_TYPES)
    if mode in ("strict", "process"):
        checks["severity_raw is not a number"] = ~F.isnan("severity_raw")
    if mode in ("strict", "publish"):
        checks["latitude out of range"] = _range("latitude")
        checks["longitude out of range"] = _range("longitude")
    return checks


def _required(events: DataFrame, required: list[str] | None) -> list[str]:
    return [c for c in (required or REQUIRED) if c in events.columns]


def is_valid(events: DataFrame, mode: str, required: list[str] | None = None) -> Column:
    """TRUE for rows that pass every check, never NULL."""
    passes = _checks(mode, _required(events, required)).values()
    return F.coalesce(all_of(passes), F.lit(False))


def with_reasons(events: DataFrame, mode: str, required: list[str] | None = None) -> DataFrame:
    """Adds ``reasons``, the list of failed checks (empty for a valid row)."""
    checks = _checks(mode, _required(events, required))
    failed = [F.when(~passes, F.lit(message)) for message, passes in checks.items()]
    return events.withColumn("reasons", F.array_compact(F.array(*failed)))


def split_valid(
    events: DataFrame, mode: str, required: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``reasons``)."""
    passes = _checks(mode, _required(events, required)).values()
    # a plain conjunction, so its parts can be pushed into the scan
    valid = events.filter(all_of(passes))
    rejects = events.filter(~is_valid(events, mode, required))
    return valid, with_reasons(rejects, mode, required)


def require_valid(events: DataFrame, required: list[str] | None = None) -> DataFrame:
    """The events, or ``ValueError`` with the reasons counted if any row fails the strict gate."""
    _, rejects = split_valid(events, "strict", required)
    counted = rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").count()
    failures = counted.orderBy("reason").collect()  # one row per kind of failure
    if failures:
        raise ValueError("; ".join(f"{r['reason']}: {r['count']}" for r in failures))
    return events


# --- reports -----------------------------------------------------------------


def minimum_counts(events: DataFrame, minimum: int = C.MIN_EVENTS_PER_TYPE) -> DataFrame:
    counted = events.groupBy("event_type").agg(F.count("*").alias("row_count"))
    return counted.withColumn("passed", F.col("row_count") >= minimum)


def schema_report(events: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Per type: rows with a missing field, an unknown type, no number, bad coordinates."""
    columns = [c for c in (required or REQUIRED) if c in events.columns]
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    bad_number = F.col("severity_raw").isNull() | F.isnan("severity_raw")
    in_range = F.coalesce(geo.in_range(F.col("latitude"), F.col("longitude")), F.lit(False))
    return events.groupBy("event_type").agg(
        F.count("*").alias("row_count"),
        F.count_if(any_missing).alias("missing_fields"),
        F.count_if(F.coalesce(~F.col("event_type").isin(*C.EVENT_TYPES), F.lit(True))).alias(
            "unknown_type"
        ),
        F.count_if(bad_number).alias("non_numeric"),
        F.count_if(~in_range).alias("out_of_range"),
    )


def spread_report(events: DataFrame) -> DataFrame:
    """Per type: severity within its plausible range, and maximum above twice the mean."""
    low = F.create_map(*[F.lit(v) for t, r in C.SEVERITY_RANGES.items() for v in (t, r[0])])
    high = F.create_map(*[F.lit(v) for t, r in C.SEVERITY_RANGES.items() for v in (t, r[1])])
    kind = F.col("event_type")
    return (
        events.groupBy("event_type")
        .agg(
            F.min("severity_raw").alias("min_severity"),
            F.max("severity_raw").alias("max_severity"),
            F.avg("severity_raw").alias("_mean"),
        )
        .select(
            "event_type",
            "min_severity",
            "max_severity",
            (
                (F.col("min_severity") >= F.try_element_at(low, kind))
                & (F.col("max_severity") <= F.try_element_at(high, kind))
            ).alias("in_range"),
            F.when(F.col("_mean") > 0, F.col("max_severity") > F.col("_mean") * 2)
            .otherwise(F.lit(True))
            .alias("has_spread"),
        )
    )


def noise_report(events: DataFrame) -> DataFrame:
    """Per type: number of zero readings and whether there is any."""
    zeros = events.groupBy("event_type").agg(
        F.count_if(F.col("severity_raw") == 0.0).alias("zero_count")
    )
    return zeros.withColumn("passed", F.col("zero_count") >= 1)


def timestamp_report(events: DataFrame, min_days: int = C.MIN_SPAN_DAYS) -> DataFrame:
    """Per type and over all (event_type ``*``): bad timestamps, span in days, span check."""
    parsed = events.withColumn("_ts", ts.parse_iso(F.col("timestamp")))
    whole_days = F.floor(
        (F.unix_seconds(F.max("_ts")) - F.unix_seconds(F.min("_ts"))) / F.lit(86400)
    )
    return (
        parsed.rollup("event_type")
        .agg(
            F.grouping("event_type").alias("_all"),
            F.count_if(F.col("_ts").isNull()).alias("bad_timestamps"),
            whole_days.alias("span_days"),
        )
        .select(
            F.when(F.col("_all") == 1, F.lit("*")).otherwise(F.col("event_type")).alias("event_type"),
            "bad_timestamps",
            "span_days",
            (F.col("span_days") >= min_days).alias("span_ok"),
        )
    )
