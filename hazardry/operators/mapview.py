"""Map queries: clusters at low zoom, single events at high zoom.

The sums of the zooms up to the deepest of ``PYRAMID_ZOOMS`` are kept per month,
type and cell by every load.  A map takes cells wholly inside its box, of months
wholly inside its range, from there and reads facts for the ragged edges only.
Deeper zooms have about as many cells as events; their boxes are small, and they
read facts alone.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo
from hazardry.functions.timestamps import time_key_text
from hazardry.operators.star import Star, date_number


def map_total(star: Star, box: tuple, start_date: str, end_date: str, zoom: int) -> DataFrame:
    """mode (``clusters`` or ``points``) and total, the number of all events in the box and range.

    One row, also where a minimum, a cap or an empty box leaves no cluster or point.
    """
    mode = "clusters" if zoom <= C.MAP_MAX_CLUSTER_ZOOM else "points"
    cells = map_cells(star, "square", zoom, box, start_date, end_date)
    return cells.agg(F.lit(mode).alias("mode"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("total"))


def grid_cells(points: DataFrame, cell: float, *by: str) -> DataFrame:
    """Square-grid cells per type, and per columns of ``by``: sums of position and count of events.

    A cell is the rounded quotient of the coordinate and the cell size.
    """
    return points.groupBy(
        *by,
        _cell("latitude", cell).alias("cell_lat"),
        _cell("longitude", cell).alias("cell_lon"),
        "event_type_id",
    ).agg(
        F.sum("latitude").alias("lat_sum"),
        F.sum("longitude").alias("lng_sum"),
        F.count("*").alias("event_count"),
    )


BLOCK_DEGREES = 15
_SUMS = ("lat_sum", "lng_sum", "event_count")
_SIZES = {"square": (C.SQUARE_CELL_DEGREES, 1.0), "pre": (C.PRE_CELL_DEGREES, 0.1)}


def _cell(position: str, size: float) -> Column:
    return F.round(F.col(position) / size)


def _added(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def pyramid_rows(facts: DataFrame, tasks: Sequence[int] = ()) -> DataFrame:
    """Sums per kind of cell, zoom, month, type and cell.

    Facts are shuffled once, by range of month and block of BLOCK_DEGREES; every
    zoom is added up from there within the tasks.  A cell on the rim of a block
    has a row in each block it touches, as it has one for each load; readers add
    rows.  ``tasks`` may hold the number of ranges, which bounds what a task holds.
    """
    block = F.floor(F.col("latitude") / BLOCK_DEGREES) * 360 + F.floor(F.col("longitude") / BLOCK_DEGREES)
    slim = facts.select(F.expr("cast(time_id div 10000 as int)").alias("month"), block.alias("block"), "event_type_id", "latitude", "longitude")
    dealt = slim.repartitionByRange(*tasks, "month", "block")
    levels = [
        grid_cells(dealt, sizes[zoom], "month", "block").drop("block").withColumns({"kind": F.lit(kind), "zoom": F.lit(zoom)})
        for kind, (sizes, _) in _SIZES.items()
        for zoom in sorted(C.PYRAMID_ZOOMS)
    ]
    return reduce(DataFrame.unionByName, levels)


def _whole_months(start_date: str | None, end_date: str | None) -> tuple[int, int]:
    """First and last month (yyyymm) of which every day is in the range; the first is after the last if there is none."""
    first, last = date_number(start_date) or 0, date_number(end_date) or 99991231
    low = first // 100 if first % 100 <= 1 else _next_month(first // 100)
    after = datetime.date(last // 10000, last // 100 % 100, last % 100) + datetime.timedelta(1) if last < 99991231 else None
    high = last // 100 if after is None or after.day == 1 else _next_month(last // 100, -1)
    return low, high


def _next_month(month: int, step: int = 1) -> int:
    n = month // 100 * 12 + month % 100 - 1 + step
    return n // 12 * 100 + n % 12 + 1


def _whole_cells(low: float, high: float, size: float) -> tuple[int, int]:
    """First and last cell that lies inside low..high, short of it by a hair against rounding."""
    hair = 1e-6
    return math.ceil(low / size + 0.5 + hair), math.floor(high / size - 0.5 - hair)


def map_cells(star: Star, kind: str, zoom: int, box: tuple, start_date: str, end_date: str, size: float | None = None) -> DataFrame:
    """Cells per type of a box and a date range, as :func:`grid_cells` of the facts gives them.

    ``kind`` is ``square`` or ``pre``.  A ``size`` of one's own reads facts alone.
    """
    sizes, default = _SIZES[kind]
    degrees = size or sizes.get(zoom, default)
    facts = star.facts(start_date, end_date, box=box)
    (south, north), (west, east) = _whole_cells(*box[:2], degrees), _whole_cells(*box[2:], degrees)
    first, last = _whole_months(start_date, end_date)
    if star.pyramid is None or size or zoom not in C.PYRAMID_ZOOMS or south > north or west > east or first > last:
        return grid_cells(facts, degrees)
    kept = star.pyramid.filter(
        (F.col("kind") == kind)
        & (F.col("zoom") == zoom)
        & F.col("month").between(first, last)
        & F.col("cell_lat").between(float(south), float(north))
        & F.col("cell_lon").between(float(west), float(east))
    )
    inside = _cell("latitude", degrees).between(float(south), float(north)) & _cell("longitude", degrees).between(float(west), float(east))
    # what is pushed into the scan: months at the ends, or positions at the rim or up to a cell within it
    months = (F.col("time_id") < first * 10000) | (F.col("time_id") >= _next_month(last) * 10000)
    lat, lon = F.col("latitude"), F.col("longitude")
    rim = (lat < south * degrees) | (lat > north * degrees) | (lon < west * degrees) | (lon > east * degrees)
    edge = facts.filter((months | rim) & (months | ~inside))
    return _added(
        kept.select("cell_lat", "cell_lon", "event_type_id", *_SUMS).unionByName(grid_cells(edge, degrees)), "cell_lat", "cell_lon", "event_type_id"
    )


def _centers(cells: DataFrame) -> DataFrame:
    return cells.select(
        (F.col("lat_sum") / F.col("event_count")).alias("lat"),
        (F.col("lng_sum") / F.col("event_count")).alias("lng"),
        "event_type",
        "event_count",
    )


def map_grid(
    star: Star, box: tuple, zoom: int, start_date: str, end_date: str, cell: float | None = None
) -> DataFrame:
    """lat, lng, event_type, event_count of square cells; no minimum, no cap, largest first."""
    cells = map_cells(star, "square", zoom, box, start_date, end_date, cell)
    return _centers(star.with_type_name(cells)).orderBy(F.desc("event_count"), "event_type", "lat", "lng")


def map_hex(
    star: Star,
    box: tuple,
    zoom: int,
    start_date: str,
    end_date: str,
    min_count: int | None = None,
    cap: int | None = None,
) -> DataFrame:
    """lat, lng, event_type, event_count of hexagonal cells.

    Points are gathered in fine square cells first; each of those goes to the
    hexagon that holds its mean position, and a hexagon's position is the mean
    weighted by count.  ``min_count`` and ``cap`` (largest clusters per type)
    default to the tables by zoom.  What they leave out is in :func:`map_total`.
    Ranked are clusters, of which the tiling bounds the number, not events.  The hexagons tile the latitude/longitude
    plane; they are not cells of a spherical index.
    """
    edge = geo.hex_edge_degrees(C.HEX_RESOLUTION.get(zoom, 5))
    minimum = C.MIN_CLUSTER_COUNT.get(zoom, 0) if min_count is None else min_count
    limit = C.MAX_CLUSTERS_PER_TYPE.get(zoom) if cap is None else cap

    fine = map_cells(star, "pre", zoom, box, start_date, end_date)
    mean_lat = F.col("lat_sum") / F.col("event_count")
    mean_lng = F.col("lng_sum") / F.col("event_count")
    clusters = (
        fine.groupBy(geo.hex_cell(mean_lat, mean_lng, edge).alias("cell"), "event_type_id")
        .agg(
            F.sum("lat_sum").alias("lat_sum"),
            F.sum("lng_sum").alias("lng_sum"),
            F.sum("event_count").alias("event_count"),
        )
        .filter(F.col("event_count") >= minimum)
    )
    centers = _centers(star.with_type_name(clusters))
    if limit is None:
        return centers
    largest = Window.partitionBy("event_type").orderBy(F.desc("event_count"), "lat", "lng")
    return (
        centers.withColumn("_rank", F.row_number().over(largest))
        .filter(F.col("_rank") <= limit)
        .drop("_rank")
    )


def map_points(star: Star, box: tuple, start_date: str, end_date: str, limit: int = C.MAP_POINT_LIMIT) -> DataFrame:
    """The latest events in the box, with ``total_count`` of all that match."""
    facts = star.facts(start_date, end_date, box=box)
    newest = [F.desc("time_id"), F.asc("event_id")]
    latest = facts.orderBy(*newest).limit(limit)
    return star.with_type_name(latest).select(
        "event_id",
        "event_type",
        "severity_level",
        "latitude",
        "longitude",
        time_key_text(F.col("time_id")).alias("event_time"),
        facts.agg(F.count("*")).scalar().alias("total_count"),
    )


def map_view(
    star: Star,
    min_lat: float,
    max_lat: float,
    min_lon: float,
    max_lon: float,
    zoom: int,
    start_date: str = C.MAP_FIRST_DATE,
    end_date: str | None = None,
) -> DataFrame:
    """Clusters up to zoom 9, single events above; :func:`map_total` tells which, and how many events there are."""
    end_date = end_date or datetime.date.today().isoformat()
    if min_lat >= max_lat:
        raise ValueError("min_lat must be less than max_lat")
    if min_lon >= max_lon:
        raise ValueError("min_lon must be less than max_lon")
    if start_date > end_date:
        raise ValueError("start_date must be on or before end_date")
    box = (min_lat, max_lat, min_lon, max_lon)
    if zoom <= C.MAP_MAX_CLUSTER_ZOOM:
        return map_hex(star, box, zoom, start_date, end_date)
    return map_points(star, box, start_date, end_date)
