"""Severity levels and storm scales as CASE expressions built from the fixed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardry import constants as C


def severity_level(
    event_type: Column, severity: Column, profile: str = "cm", below_min: str = "drop"
) -> Column:
    """Level of a reading.

    ``profile``    which threshold table applies: ``"fmi"`` or ``"cm"``.
    ``below_min``  what a reading under the minimum becomes: ``"low"`` keeps it as
                   LOW, ``"drop"`` gives NULL (callers filter it), ``"label"`` says DROP.

    A NULL or NaN reading has no level.  An unknown type has none either, except
    under ``"label"``, where the fallback thresholds apply.

    The level is the number of thresholds reached, looked up by type in a
    constant map: a CASE over types and levels is several times more code, too
    much for the JIT compiler once a plan holds it twice.
    """
    if below_min not in ("low", "drop", "label"):
        raise ValueError(f"below_min must be low, drop or label, not {below_min!r}")
    below = {"low": "LOW", "drop": None, "label": "DROP"}[below_min]
    bounds = _bounds(event_type, profile)
    if below_min == "label":
        bounds = F.coalesce(bounds, _array_of(C.FALLBACK_THRESHOLDS))
    number = F.nanvl(severity, F.lit(None).cast("double"))
    reached = sum((number >= F.get(bounds, F.lit(i))).cast("int") for i in range(4))
    labels = F.array(F.lit(below).cast("string"), *[F.lit(v) for v in C.SEVERITY_LEVELS])
    return F.get(labels, reached)


def reaches_minimum(event_type: Column, severity: Column, profile: str = "cm") -> Column:
    """Whether a reading (not NaN) is of a known type and at least its minimum."""
    return severity >= F.get(_bounds(event_type, profile), F.lit(0))


def _array_of(values: tuple) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _bounds(event_type: Column, profile: str) -> Column:
    """The four thresholds of a type, NULL for an unknown type."""
    entries = C.SEVERITY_THRESHOLDS[profile].items()
    table = F.create_map(*[part for k, v in entries for part in (F.lit(k), _array_of(v))])
    return F.try_element_at(table, event_type)


def beaufort(wind_ms: Column) -> Column:
    """Beaufort force 0 to 12 from wind speed in m/s; a bound belongs to the force above it."""
    chain = F.when(wind_ms < C.BEAUFORT_BOUNDS[0], 0)
    for force, bound in enumerate(C.BEAUFORT_BOUNDS[1:], start=1):
        chain = chain.when(wind_ms < bound, force)
    return chain.otherwise(12)


def storm_basin(lat: Column, lon: Column) -> Column:
    """Two-letter cyclone basin of a position."""
    north = (
        F.when(lon >= 100, "WP").when(lon >= 40, "NI").when(lon < -100, "EP").otherwise("NA")
    )
    return F.when(lat >= 0, north).otherwise(F.when(lon >= 90, "SP").otherwise("SI"))


def storm_nature(wind_knots: Column, basin: Column) -> Column:
    """Depression, tropical storm, typhoon (western Pacific) or hurricane."""
    return (
        F.when(wind_knots < 34, "TD")
        .when(wind_knots < 64, "TS")
        .when(basin == "WP", "TY")
        .otherwise("HU")
    )
