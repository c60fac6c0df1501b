"""Geography on latitude/longitude columns; planar, but for polygons with great-circle edges."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardry import constants as C

SQRT3 = math.sqrt(3.0)


def hemisphere(lat: Column, lon: Column) -> Column:
    return F.concat(
        F.when(lat >= 0, "North").otherwise("South"),
        F.lit(" "),
        F.when(lon >= 0, "East").otherwise("West"),
        F.lit(" Hemisphere"),
    )


def in_box(lat: Column, lon: Column, min_lat, max_lat, min_lon, max_lon) -> Column:
    """Inclusive planar bounding box."""
    return lat.between(float(min_lat), float(max_lat)) & lon.between(float(min_lon), float(max_lon))


def _unit(lat: float, lon: float) -> tuple[float, float, float]:
    """A position as a vector from the centre of a sphere of radius one."""
    a, b = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)


def _cross(u: tuple, v: tuple) -> tuple[float, float, float]:
    return u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]


def _dot(u: tuple, v: tuple) -> float:
    return sum(a * b for a, b in zip(u, v))


_ON_EDGE = 1e-12


def _edge_normals(corners: list[tuple[float, float]]) -> list[tuple[float, float, float]]:
    """Unit normals of the planes through the edges, pointing inwards.

    Corners are (latitude, longitude), eastwards along the south first, the last
    not repeated.  The polygon must be convex, within a hemisphere, without
    repeated corners, a pole inside or the antimeridian across it.
    """
    if len(corners) < 3:
        raise ValueError("a polygon has three corners at least")
    lons = [lon for _, lon in corners]
    if max(lons) - min(lons) >= 180 or min(lons) < -180 or max(lons) > 180:
        raise ValueError("a polygon spans less than 180 degrees and does not cross the antimeridian")
    if any(abs(lat) >= 90 for lat, _ in corners):
        raise ValueError("corners lie between the poles")
    points = [_unit(*c) for c in corners]
    normals = []
    for a, b in zip(points, points[1:] + points[:1]):
        n = _cross(a, b)
        size = math.sqrt(_dot(n, n))
        if size < _ON_EDGE:
            raise ValueError("neighbouring corners are equal")
        normals.append(tuple(x / size for x in n))
    if any(_dot(n, p) < -_ON_EDGE for n in normals for p in points):
        raise ValueError("corners must go round a convex polygon counter-clockwise")
    return normals


def polygon_bounds(corners: list[tuple[float, float]]) -> tuple[float, float, float, float]:
    """The planar box around a polygon with great-circle edges, a hair wider.

    An edge bulges towards the nearer pole; where its highest point lies between its ends, that counts.
    """
    lats, lons = [c[0] for c in corners], [c[1] for c in corners]
    points = [_unit(*c) for c in corners]
    low, high = min(lats), max(lats)
    for a, b, n in zip(points, points[1:] + points[:1], _edge_normals(corners)):
        steep = math.hypot(n[0], n[1])
        if steep < _ON_EDGE:
            continue
        for sign in (1.0, -1.0):
            top = (-sign * n[0] * n[2] / steep, -sign * n[1] * n[2] / steep, sign * steep)
            if _dot(_cross(a, top), n) > 0 and _dot(_cross(top, b), n) > 0:
                lat = math.degrees(math.asin(top[2]))
                low, high = min(low, lat), max(high, lat)
    hair = 1e-9
    return low - hair, high + hair, min(lons) - hair, max(lons) + hair


def in_polygon(lat: Column, lon: Column, corners: list[tuple[float, float]]) -> Column:
    """Whether a position lies in a convex polygon whose edges are great circles; edges belong to it.

    A position is inside when it lies on the inner side of every edge's plane.
    The planar box around the polygon comes first and reaches the scan.
    """
    phi, theta = F.radians(lat), F.radians(lon)
    x, y, z = F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)
    inside = in_box(lat, lon, *polygon_bounds(corners))
    for a, b, c in _edge_normals(corners):
        inside = inside & (x * a + y * b + z * c >= -_ON_EDGE)
    return inside


def box_corners(min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> list[tuple[float, float]]:
    """Corners of a box in the order :func:`in_polygon` takes."""
    return [(min_lat, min_lon), (min_lat, max_lon), (max_lat, max_lon), (max_lat, min_lon)]


_CELLS_PER_ROW = 400


def degree_cell(lat: Column, lon: Column) -> Column:
    """Number of the one-degree cell of a position, row by row from the south-west."""
    row, place = F.floor(lat) + 90, F.floor(lon) + 180
    return (row * _CELLS_PER_ROW + place).cast("int")


def cells_touch_box(cell: Column, box: tuple) -> Column | None:
    """A predicate on :func:`degree_cell` that every position in the box passes.

    None for a box beyond the map, whose cells have no number of their own.
    """
    min_lat, max_lat, min_lon, max_lon = box
    if min_lon < -180 or max_lon > 180:
        return None
    first, last = math.floor(min_lat) + 90, math.floor(max_lat) + 90
    west, east = math.floor(min_lon) + 180, math.floor(max_lon) + 180
    rows = cell.between(first * _CELLS_PER_ROW, last * _CELLS_PER_ROW + _CELLS_PER_ROW - 1)
    return rows & F.pmod(cell, F.lit(_CELLS_PER_ROW)).between(west, east)


def near_box(center_lat: float, center_lon: float, km: float) -> tuple:
    """Square of +-km/111 degrees on both axes; no latitude scaling and no wrap."""
    reach = km / C.KM_PER_DEGREE
    return center_lat - reach, center_lat + reach, center_lon - reach, center_lon + reach


def near(lat: Column, lon: Column, center_lat: float, center_lon: float, km: float) -> Column:
    return in_box(lat, lon, *near_box(center_lat, center_lon, km))


def in_range(lat: Column, lon: Column) -> Column:
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def square_degrees_to_km2(area: Column, at_lat: Column) -> Column:
    return area * C.KM_PER_DEGREE * (F.lit(C.KM_PER_DEGREE) * F.cos(F.radians(at_lat)))


def floor_cell(value: Column, size: float) -> Column:
    """Lower edge of the cell of width ``size`` that holds ``value``."""
    return F.floor(value / size) * F.lit(size)


def hex_edge_degrees(resolution: int) -> float:
    """Edge of the planar hexagon whose area equals the table's for this resolution."""
    return math.sqrt(C.HEX_AREA_KM2[resolution] * 2.0 / (3.0 * SQRT3)) / C.KM_PER_DEGREE


def hex_cell(lat: Column, lon: Column, edge: float) -> Column:
    """Axial cell ``struct<q, r>`` of a pointy-top hexagon grid over the lat/lon plane."""
    half_up = lambda c: F.floor(c + 0.5)
    q = (lon * (SQRT3 / 3.0) - lat * (1.0 / 3.0)) / edge
    r = lat * (2.0 / 3.0) / edge
    s = -q - r
    rq, rr, rs = half_up(q), half_up(r), half_up(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    return F.struct(
        F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq).alias("q"),
        F.when((dq > dr) & (dq > ds), rr)
        .when(dr > ds, -rq - rs)
        .otherwise(rr)
        .alias("r"),
    )
