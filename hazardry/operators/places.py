"""Country and region of a point by its nearest known city.

The search is limited to a grid of one-degree cells (coordinates cut toward
zero): the 3x3 cells around the point, then 5x5, then 7x7; the first block that
holds any city decides, and the nearest city in it wins by squared degrees.
Ties go to the southernmost, then westernmost cell, then to file order.

Which block decides depends on the point's cell alone.  So the small side is
replicated, not the events: the gazetteer is turned into one candidate list per
cell (at most 65,000 cells), and every point meets exactly its own cell's list.
The lists are cut into chunks when one would grow too long, so a crowded cell
makes more rows, not a bigger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry.functions import geo
from hazardry.functions.lookup import country_codes
from hazardry.sources.workspace import staged

MAX_RING = 3
CHUNK_CITIES = 2048


def _cell(value: Column) -> Column:
    return value.cast("int")


def distinct_cities(gazetteer: DataFrame) -> DataFrame:
    """One city per coordinate pair: the first in file order."""
    return gazetteer.groupBy("lat", "lon").agg(
        F.min("row_no").alias("row_no"), F.min_by("cc", "row_no").alias("cc")
    )


def _neighbours(cells: DataFrame) -> DataFrame:
    """Every cell with the 7x7 offsets around it and the ring each offset belongs to."""
    span = F.expr(f"sequence(-{MAX_RING}, {MAX_RING})")
    return (
        cells.withColumn("d_lat", F.explode(span))
        .withColumn("d_lon", F.explode(span))
        .withColumn("offset_ring", F.greatest(F.abs("d_lat"), F.abs("d_lon"), F.lit(1)))
    )


def cell_candidates(gazetteer: DataFrame, chunk_cities: int = CHUNK_CITIES) -> DataFrame:
    """Candidate cities per cell: ``cell_lat, cell_lon, chunk, blocks, parts``.

    ``gazetteer`` holds row_no, lat, lon, cc.  A block is one city cell of the
    deciding ring: its offset and its cities.  ``parts`` is the number of rows of
    the cell.  Cells farther than three cells from any city have no row.
    """
    cities = distinct_cities(gazetteer).select(
        _cell(F.col("lat")).alias("city_lat"),
        _cell(F.col("lon")).alias("city_lon"),
        F.struct("lat", "lon", "row_no", "cc").alias("city"),
    )
    occupied = cities.groupBy("city_lat", "city_lon").agg(
        F.ceil(F.count("*") / F.lit(chunk_cities)).cast("int").alias("chunks")
    )
    packed = (
        cities.join(occupied, ["city_lat", "city_lon"])
        .withColumn("chunk", F.pmod(F.xxhash64("city.row_no"), F.col("chunks")).cast("int"))
        .groupBy("city_lat", "city_lon", "chunk")
        .agg(F.collect_list("city").alias("cities"))
    )
    # the first ring that meets a city, for every cell within reach of one
    deciding = (
        _neighbours(occupied)
        .groupBy(
            (F.col("city_lat") - F.col("d_lat")).alias("cell_lat"),
            (F.col("city_lon") - F.col("d_lon")).alias("cell_lon"),
        )
        .agg(F.min("offset_ring").alias("ring"))
    )
    return (
        _neighbours(deciding)
        .filter(F.col("offset_ring") == F.col("ring"))
        .withColumn("city_lat", F.col("cell_lat") + F.col("d_lat"))
        .withColumn("city_lon", F.col("cell_lon") + F.col("d_lon"))
        .join(packed, ["city_lat", "city_lon"])
        .groupBy("cell_lat", "cell_lon", "chunk")
        .agg(F.collect_list(F.struct("d_lat", "d_lon", "cities")).alias("blocks"))
        .withColumn("parts", F.count("*").over(Window.partitionBy("cell_lat", "cell_lon")))
    )


def _nearest(lat: Column, lon: Column, blocks: Column) -> Column:
    """Best city of the blocks as a struct that orders by distance, cell and file order."""

    def best_of(block: Column) -> Column:
        def ranked(city: Column) -> Column:
            d_lat, d_lon = city["lat"] - lat, city["lon"] - lon
            return F.struct(
                (d_lat * d_lat + d_lon * d_lon).alias("dist2"),
                block["d_lat"].alias("d_lat"),
                block["d_lon"].alias("d_lon"),
                city["row_no"].alias("row_no"),
                city["cc"].alias("cc"),
            )

        return F.array_min(F.transform(block["cities"], ranked))

    return F.array_min(F.transform(blocks, best_of))


def nearest_city(
    points: DataFrame,
    gazetteer: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    chunk_cities: int = CHUNK_CITIES,
) -> DataFrame:
    """``lat``, ``lon`` (distinct points of the input) and ``cc``, '' when no city is near.

    ``gazetteer`` is the city table or what :func:`cell_candidates` made of it;
    the latter is worth storing when many batches of points are looked up.  The
    city table is prepared and written at once, as it is read in two places.
    """
    distinct = points.select(lat, lon).distinct()
    prepared = "blocks" in gazetteer.columns
    candidates = gazetteer if prepared else staged(cell_candidates(gazetteer, chunk_cities), "cities")
    met = distinct.select(
        lat,
        lon,
        _cell(F.col(lat)).alias("cell_lat"),
        _cell(F.col(lon)).alias("cell_lon"),
    ).join(candidates, ["cell_lat", "cell_lon"], "left")
    best = met.select(lat, lon, "parts", _nearest(F.col(lat), F.col(lon), F.col("blocks")).alias("best"))
    found = lambda city: F.coalesce(city["cc"], F.lit("")).alias("cc")
    alone = best.filter(F.coalesce("parts", F.lit(0)) <= 1).select(lat, lon, found(F.col("best")))
    # a point of a crowded cell met several chunks and becomes one row again.  The cell is
    # not a grouping key: that would save a shuffle but forbid splitting a hot cell's join
    crowded = best.filter(F.col("parts") > 1).groupBy(lat, lon).agg(F.min("best").alias("best"))
    return alone.unionByName(crowded.select(lat, lon, found(F.col("best"))))


def with_place(points_with_code: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Country and region of a city code: name table, else the code, else 'Unknown';
    region table, else the hemisphere."""
    codes = F.broadcast(country_codes(points_with_code.sparkSession))  # fixed, about 140 rows
    code = F.when(F.col("cc") != "", F.col("cc"))
    return points_with_code.join(codes, "cc", "left").select(
        *points_with_code.columns,
        F.coalesce("country_name", code, F.lit("Unknown")).alias("country"),
        F.coalesce("region_name", geo.hemisphere(F.col(lat), F.col(lon))).alias("region"),
    )


def classify_points(
    points: DataFrame,
    gazetteer: DataFrame | None,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Distinct points with country and region; without a gazetteer, hemispheres only."""
    if gazetteer is None:
        coded = points.select(lat, lon).distinct().withColumn("cc", F.lit(""))
    else:
        coded = nearest_city(points, gazetteer, lat, lon)
    return with_place(coded, lat, lon)
