"""Area of the convex hull of each group's points, safe for groups of any size.

The hull of a union is the hull of the partial hulls, so a group is reduced in
steps and never gathered whole:

1. per group and latitude, only the westmost and eastmost point can be on the
   hull: a built-in aggregation, combined on the map side, spread over
   (group, latitude) so that a hot group fills many tasks;
2. each task reduces its share of a group to that share's hull (sorted rows, one
   group at a time, Arrow batches);
3. the hulls of the shares, a few points per task, meet in one small array.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _chain(points: list[tuple]) -> list[tuple]:
    """One side of the hull of lexicographically sorted points, without its last point."""
    side: list[tuple] = []
    for x, y in points:
        while len(side) >= 2:
            (ax, ay), (bx, by) = side[-2], side[-1]
            if (bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0:
                break
            side.pop()
        side.append((x, y))
    return side[:-1]


def hull_corners(points: Iterable[tuple]) -> list[tuple]:
    """Corners of the hull, in order; fewer than three distinct points come back sorted."""
    distinct = sorted(set(points))
    if len(distinct) < 3:
        return distinct
    return _chain(distinct) + _chain(distinct[::-1])


def polygon_area(corners: list[tuple]) -> float:
    if len(corners) < 3:
        return 0.0
    shifted = corners[1:] + corners[:1]
    return abs(sum(x * v - u * y for (x, y), (u, v) in zip(corners, shifted))) / 2.0


_NOWHERE = (float("nan"), float("nan"))


def _shrink_shares(keys: list[str]):
    """Reduce each group's rows of this task (rows are sorted by group) to a partial hull.

    Only the last group of a batch can go on in the next one, so its corners are
    all the state there is.  A group without any position keeps one empty row.
    """

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, []
        for batch in batches:
            if batch.empty:
                continue
            starts = np.flatnonzero(batch[keys].ne(batch[keys].shift()).any(axis=1).to_numpy())
            names = list(batch[keys].iloc[starts].itertuples(index=False, name=None))
            lat, west, east = (batch[c].to_numpy().tolist() for c in ("lat", "west", "east"))
            done_keys, done = [], []
            for name, start, end in zip(names, starts.tolist(), [*starts[1:].tolist(), len(batch)]):
                if held and name != held_key:
                    done_keys += [held_key] * len(held)
                    done += held
                    held = []
                ends = [*zip(lat[start:end], west[start:end]), *zip(lat[start:end], east[start:end])]
                corners = hull_corners(p for p in held + ends if p[0] == p[0])
                held_key, held = name, corners or [_NOWHERE]
            yield _rows(keys, done_keys, done)
        yield _rows(keys, [held_key] * len(held), held)

    return shrink


def _rows(keys: list[str], names: list[tuple], points: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(keys, zip(*names))) if names else {k: [] for k in keys}
    lats, lons = zip(*points) if points else ((), ())
    return pd.DataFrame(columns | {"lat": lats, "lon": lons})


@F.pandas_udf(T.DoubleType())
def _hull_area(lats: pd.Series, lons: pd.Series) -> pd.Series:
    groups = zip(lats, lons)
    return pd.Series([polygon_area(hull_corners(zip(y.tolist(), x.tolist()))) for y, x in groups])


def hull_area(points: DataFrame, keys: list[str], lat: str, lon: str) -> DataFrame:
    """``keys`` and ``hull_area`` (square degrees) per group.  Keys must not be NULL.

    A group of fewer than three distinct points, or of collinear ones, has area 0.
    Points without a position (NULL or NaN in either coordinate) do not count; a
    group of such points alone has area 0.
    """
    placed = F.nanvl(lat, F.lit(None)).isNotNull() & F.nanvl(lon, F.lit(None)).isNotNull()
    edges = points.groupBy(*keys, F.when(placed, F.col(lat)).alias("lat")).agg(
        F.min(F.when(placed, F.col(lon))).alias("west"), F.max(F.when(placed, F.col(lon))).alias("east")
    )
    fields = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    schema = ", ".join([*(f"{k} {fields[k]}" for k in keys), "lat double", "lon double"])
    shares = edges.sortWithinPartitions(*keys).mapInPandas(_shrink_shares(keys), schema)
    return (
        shares.groupBy(*keys)
        .agg(F.collect_list("lat").alias("_lats"), F.collect_list("lon").alias("_lons"))
        .select(*keys, _hull_area("_lats", "_lons").alias("hull_area"))
    )
