"""Column functions against plain Python on the same values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry.functions import geo, severity
from hazardry.functions import timestamps as ts
from hazardry.functions.rounding import round_exact

# kind, reading, level under profile "cm" when readings below the minimum are dropped
PROBES = [
    ("earthquake", [(0.0, None), (1.2, None), (2.5, "LOW"), (3.8, "MEDIUM"), (6.0, "HIGH"), (8.5, "CRITICAL")]),
    ("fire", [(0.0, None), (50.0, "LOW"), (500.0, "MEDIUM"), (3000.0, "HIGH"), (8000.0, "CRITICAL")]),
    ("flood", [(2.0, None), (20.0, "LOW"), (100.0, "MEDIUM"), (400.0, "HIGH"), (1000.0, "CRITICAL")]),
    ("storm", [(10.0, None), (45.0, "LOW"), (90.0, "MEDIUM"), (150.0, "HIGH"), (250.0, "CRITICAL")]),
]


def levels(spark, rows, profile, below):
    df = spark.createDataFrame(rows, "kind string, x double")
    out = df.select("*", severity.severity_level(F.col("kind"), F.col("x"), profile, below).alias("level"))
    return [r["level"] for r in out.collect()]


def test_severity_probes(spark):
    rows = [(kind, x) for kind, probes in PROBES for x, _ in probes]
    want = [level for _, probes in PROBES for _, level in probes]
    assert levels(spark, rows, "cm", "drop") == want


@pytest.mark.parametrize("profile", ["fmi", "cm"])
def test_severity_at_every_threshold(spark, profile):
    rows, want = [], []
    for kind, bounds in C.SEVERITY_THRESHOLDS[profile].items():
        for bound, at, under in zip(bounds, C.SEVERITY_LEVELS, ("DROP", *C.SEVERITY_LEVELS)):
            rows += [(kind, bound), (kind, math.nextafter(bound, 0.0))]
            want += [at, under]
    assert levels(spark, rows, profile, "label") == want


def test_severity_below_minimum_choices(spark):
    rows = [("fire", 1.0), ("fire", None), ("fire", float("nan")), ("comet", 1.0), ("comet", 9.0)]
    assert levels(spark, rows, "fmi", "low") == ["LOW", None, None, None, None]
    assert levels(spark, rows, "fmi", "drop") == [None] * 5
    assert levels(spark, rows, "fmi", "label") == ["DROP", None, None, "MEDIUM", "CRITICAL"]
    with pytest.raises(ValueError):
        severity.severity_level(F.lit("fire"), F.lit(1.0), "fmi", "keep")


def test_round_exact_equals_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, 3.5, -2.5, -2.675, 23.15, 12.5 * 1.852, 0.0, -0.5, 1e9 + 0.05]
    values += [round(rng.uniform(-5000, 5000), 3) for _ in range(2000)]
    values += [rng.uniform(-180, 180) for _ in range(2000)]
    values += [k / 64 for k in range(-640, 640)] + [k * 0.05 for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", *[round_exact(F.col("x"), n).alias(f"r{n}") for n in (0, 1, 2, 4, 6)]).collect()
    for row in out:
        for n in (0, 1, 2, 4, 6):
            assert row[f"r{n}"] == round(row["x"], n), (row["x"], n)


def test_round_exact_on_both_sides_of_its_bound(spark):
    rng = random.Random(9)
    small = [rng.uniform(2.0**48, 2.0**50) / 10**4 for _ in range(3000)]
    large = [rng.uniform(2.0**52, 2.0**60) / 10**4 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in [*small, *large, -large[0], 1e300, float("inf")]], "x double")
    for x, r in df.select("x", round_exact(F.col("x"), 4)).collect():
        assert r == (round(x, 4) if abs(x) < 1e290 else x), x


def test_round_exact_passes_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    out = [r[0] for r in df.select(round_exact(F.col("x"), 2)).collect()]
    assert out[0] is None and math.isnan(out[1])


def test_beaufort_bounds(spark):
    df = spark.createDataFrame([(b,) for b in C.BEAUFORT_BOUNDS] + [(0.0,), (99.0,)], "w double")
    got = [r[0] for r in df.select(severity.beaufort(F.col("w"))).collect()]
    assert got == [*range(1, 13), 0, 12]


def test_basin_and_nature(spark):
    rows = [(10.0, 120.0, 70.0), (10.0, 60.0, 70.0), (10.0, -120.0, 40.0), (10.0, -60.0, 20.0), (-10.0, 100.0, 64.0), (-10.0, 20.0, 63.9)]
    df = spark.createDataFrame(rows, "lat double, lon double, wind double")
    basin = severity.storm_basin(F.col("lat"), F.col("lon"))
    got = [tuple(r) for r in df.select(basin, severity.storm_nature(F.col("wind"), basin)).collect()]
    assert got == [("WP", "TY"), ("NI", "HU"), ("EP", "TS"), ("NA", "TD"), ("SP", "HU"), ("SI", "TS")]


def test_time_texts(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "5", "31-12-2023", 2359), ("2024-01-05", "0130", "31-02-2023", 1200), ("2024-01-05", "1915", "1-3-2024", 2400), ("2024-01-05", "1915", "x", 0)],
        "d string, t string, dmy string, hhmm int",
    )
    out = df.select(
        ts.date_and_hhmm_text(F.col("d"), F.col("t")).alias("a"),
        ts.day_first_date_and_hhmm(F.col("dmy"), F.col("hhmm"), "fallback").alias("b"),
    ).collect()
    assert [r["a"] for r in out] == ["2024-01-05T00:05:00Z", "2024-01-05T01:30:00Z", "2024-01-05T19:15:00Z", "2024-01-05T19:15:00Z"]
    assert [r["b"] for r in out] == ["2023-12-31T23:59:00Z", "fallback", "fallback", "fallback"]


def test_epochs_are_cut_to_seconds(spark):
    df = spark.createDataFrame([(1704067200999, 1704067201)], "ms long, s long")
    row = df.select(
        ts.iso_text(ts.from_epoch_millis(F.col("ms"))), ts.iso_text(ts.from_epoch_seconds(F.col("s")))
    ).first()
    assert tuple(row) == ("2024-01-01T00:00:00Z", "2024-01-01T00:00:01Z")


def test_month_name_is_full(spark):
    df = spark.createDataFrame([(2024, m) for m in range(1, 13)], "y int, m int")
    names = [r[0] for r in df.select(ts.month_name(F.col("y"), F.col("m"))).collect()]
    assert names[0] == "January" and names[2] == "March" and names[11] == "December"


def test_hexagons_tile_the_plane(spark):
    """Every point lies no farther from its cell's centre than the corner distance."""
    edge = geo.hex_edge_degrees(3)
    rng = random.Random(3)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    for r in df.select("lat", "lon", geo.hex_cell(F.col("lat"), F.col("lon"), edge).alias("c")).collect():
        q, s = r["c"]["q"], r["c"]["r"]
        x, y = edge * geo.SQRT3 * (q + s / 2), edge * 1.5 * s
        assert math.hypot(r["lon"] - x, r["lat"] - y) <= edge * 1.0001


def test_cells_of_a_box_hold_all_its_points(spark):
    rng = random.Random(9)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(3000)]
    points += [(lat, lon) for lat in (-90.0, -0.5, 0.0, 90.0) for lon in (-180.0, -0.5, 0.0, 180.0)]
    df = spark.createDataFrame(points, "lat double, lon double").withColumn("c", geo.degree_cell(F.col("lat"), F.col("lon")))
    for box in [(-90.0, 90.0, -180.0, 180.0), (-10.5, 3.2, -20.1, 40.0), (89.5, 90.0, 179.5, 180.0), (-1.0, 0.0, -1.0, 0.0)]:
        inside = geo.in_box(F.col("lat"), F.col("lon"), *box)
        touched = geo.cells_touch_box(F.col("c"), box)
        assert df.filter(inside & ~touched).count() == 0
        loose = geo.in_box(F.col("lat"), F.col("lon"), box[0] - 1, box[1] + 1, box[2] - 1, box[3] + 1)
        assert df.filter(touched & ~loose).count() == 0
    assert geo.cells_touch_box(F.col("c"), (0.0, 1.0, 179.0, 181.0)) is None


def slerp_side(point, corners):
    """Whether a point is inside, by the triple product of each edge's ends with it."""
    def unit(lat, lon):
        a, b = math.radians(lat), math.radians(lon)
        return [math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)]

    def det(u, v, w):
        return (
            u[0] * (v[1] * w[2] - v[2] * w[1]) - u[1] * (v[0] * w[2] - v[2] * w[0]) + u[2] * (v[0] * w[1] - v[1] * w[0])
        )

    return min(det(unit(*a), unit(*b), unit(*point)) for a, b in zip(corners, corners[1:] + corners[:1]))


POLYGONS = [
    geo.box_corners(20.0, 50.0, 60.0, 120.0),
    geo.box_corners(-50.0, -20.0, -170.0, -10.0),
    geo.box_corners(-30.0, 40.0, -60.0, 60.0),
    [(10.0, 10.0), (-5.0, 40.0), (30.0, 35.0)],
    [(0.0, 0.0), (0.0, 20.0), (10.0, 25.0), (18.0, 10.0), (9.0, -4.0)],
]


@pytest.mark.parametrize("corners", POLYGONS)
def test_polygon_with_great_circle_edges(spark, corners):
    rng = random.Random(4)
    points = [(rng.uniform(-89, 89), rng.uniform(-179, 179)) for _ in range(4000)] + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(points, "lat double, lon double")
    got = {(r["lat"], r["lon"]) for r in df.filter(geo.in_polygon(F.col("lat"), F.col("lon"), corners)).collect()}
    west, east = min(c[1] for c in corners), max(c[1] for c in corners)
    want = {p for p in points if None not in p and slerp_side(p, corners) > 0 and west <= p[1] <= east}
    assert got == want and len(got) > 20


def test_polygon_bulges_towards_the_pole(spark):
    corners = geo.box_corners(20.0, 50.0, 60.0, 120.0)
    middle = math.degrees(math.atan(math.tan(math.radians(50)) / math.cos(math.radians(30))))
    assert geo.polygon_bounds(corners)[1] == pytest.approx(middle, abs=1e-6)
    df = spark.createDataFrame([(middle - 0.01, 90.0), (middle + 0.01, 90.0), (20.5, 90.0), (50.0, 60.0)], "lat double, lon double")
    got = [tuple(r) for r in df.filter(geo.in_polygon(F.col("lat"), F.col("lon"), corners)).collect()]
    assert got == [(middle - 0.01, 90.0), (50.0, 60.0)]


@pytest.mark.parametrize(
    "corners",
    [
        [(0.0, 0.0), (1.0, 1.0)],
        [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)],
        [(0.0, -100.0), (0.0, 100.0), (10.0, 0.0)],
        [(0.0, 0.0), (0.0, 0.0), (10.0, 0.0)],
        [(0.0, 0.0), (0.0, 10.0), (90.0, 0.0)],
        [(0.0, 0.0), (0.0, 20.0), (4.0, 10.0), (20.0, 20.0), (20.0, 0.0)],
    ],
)
def test_polygons_that_are_refused(corners):
    with pytest.raises(ValueError):
        geo.in_polygon(F.col("lat"), F.col("lon"), corners)


def test_lookup_tables_are_whole():
    assert len(C.COUNTRY_BY_CODE) == 140 and len(C.REGION_BY_CODE) == 140
    assert len(set(C.REGION_BY_CODE.values())) == 23
    assert "SG" not in C.COUNTRY_BY_CODE and "GW" not in C.REGION_BY_CODE
