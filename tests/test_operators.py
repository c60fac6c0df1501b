"""Operators on tiny literal frames and against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry import schemas
from hazardry.operators import adapters, documents, fires, floods, hull, normalize, places, processing, quality, ranking

UNIFIED = "event_id string, event_type string, severity_raw double, latitude double, longitude double, timestamp string, source string"


def event(i, kind="fire", x=60.0, lat=1.0, lon=2.0, at="2024-11-01T08:00:00Z", source="S"):
    return (i, kind, x, lat, lon, at, source)


# --- validation -------------------------------------------------------------------


def bad_events(spark):
    return spark.createDataFrame(
        [
            event("good"),
            event(None),
            event("kind", kind="volcano"),
            event("null", x=None),
            event("nan", x=float("nan")),
            event("north", lat=90.5),
            event("edge", lat=-90.0, lon=180.0),
            event("west", lon=-180.1),
        ],
        UNIFIED,
    )


@pytest.mark.parametrize(
    "mode, kept",
    [
        ("strict", {"good", "edge"}),
        ("publish", {"good", "edge", "nan"}),
        ("process", {"good", "edge", "north", "west"}),
    ],
)
def test_gates(spark, mode, kept):
    events = bad_events(spark)
    valid, rejects = quality.split_valid(events, mode)
    assert {r["event_id"] for r in valid.collect()} == kept
    assert valid.count() + rejects.count() == events.count()
    assert rejects.filter(F.size("reasons") == 0).count() == 0


def test_reasons_name_every_failure(spark):
    df = spark.createDataFrame([event(None, kind="volcano", lat=99.0)], UNIFIED)
    assert quality.with_reasons(df, "strict").first()["reasons"] == [
        "missing event_id",
        "unknown event_type",
        "latitude out of range",
    ]


def test_strict_mode_raises(spark):
    with pytest.raises(ValueError, match="unknown event_type: 1"):
        quality.require_valid(bad_events(spark))
    good = spark.createDataFrame([event("a")], UNIFIED)
    assert quality.require_valid(good) is good


# --- processing -------------------------------------------------------------------


def test_processed_event_shape(spark):
    out = processing.process_events(spark.createDataFrame([event("abc", "flood", 300.0)], UNIFIED), "cm")
    assert out.columns == ["event_id", "event_type", "severity_level", "latitude", "longitude", "event_time", "processed_at", "source"]
    row = out.first()
    assert row["severity_level"] == "HIGH" and row["event_time"] == "2024-11-01T08:00:00Z"


def test_below_minimum_is_kept_as_low_or_dropped(spark):
    df = spark.createDataFrame([event("a", x=1.0), event("b", x=6.0)], UNIFIED)
    assert processing.process_events(df, "fmi", "low").count() == 2
    assert processing.process_events(df, "fmi", "drop").count() == 1


def test_report_adds_up(spark):
    report = {r["measure"]: r["value"] for r in processing.processing_report(bad_events(spark), "cm").collect()}
    assert report["received"] == 8 == report["processed"] + report["total_dropped"]
    assert report["pass_rate"] + report["drop_rate"] == pytest.approx(100.0)


# --- normalisers ------------------------------------------------------------------


def test_quake_normaliser(spark):
    features = [
        Row(id="a", properties={"mag": 5.0, "time": 1728067929123, "net": "jp"}, geometry={"type": "Point", "coordinates": [119.8, -6.2, 10.0]}),
        Row(id="b", properties={"mag": 5.0, "time": 1728067929123}, geometry={"type": "Point", "coordinates": [119.8]}),
    ]
    raw = spark.createDataFrame([(f.id, Row(**{n: f.properties.get(n) for n in schemas.QUAKE_FEATURE["properties"].dataType.names}), Row(**f.geometry)) for f in features], schemas.QUAKE_FEATURE)
    events, rejects = normalize.normalize_all({"earthquake": raw})
    row = events.first()
    assert (row["latitude"], row["longitude"], row["source"]) == (-6.2, 119.8, "JMA")
    assert row["timestamp"] == "2024-10-04T18:52:09Z"
    assert [r["reason"] for r in rejects.collect()] == ["latitude"]


def test_storm_and_flood_units(spark):
    storms = spark.createDataFrame([("s", 2024, "NA", "2024-09-01 06:00:00", "TS", 1.0, 2.0, None), ("t", 2024, "NA", "2024-09-01 06:00:00", "TS", 1.0, 2.0, 12.5)], schemas.STORM_RECORD)
    rows = {r["severity_raw"] for r in normalize.normalize_storms(storms).collect()}
    assert rows == {0.0, round(12.5 * 1.852, 1)}
    flood = spark.createDataFrame([(1, 1.0, 2.0, 3.3, "2024-09-01T06:00:00")], schemas.FLOOD_RECORD)
    row = normalize.normalize_floods(flood).first()
    assert row["severity_raw"] == round(3.3 * 30.48, 2) and row["timestamp"] == "2024-09-01T06:00:00Z"


def test_ids_are_repeatable(spark):
    fire = spark.createDataFrame([(1.0, 2.0, "2024-01-01", "130", 5.0)], schemas.FIRE_RECORD)
    first, second = (normalize.normalize_fires(fire).first()["event_id"] for _ in range(2))
    assert first == second


def test_rupture_area(spark):
    df = spark.createDataFrame([(m / 10,) for m in range(95)], "m double")
    for r in df.select("m", adapters.rupture_area_km2(F.col("m")).alias("a")).collect():
        assert r["a"] == pytest.approx(round(10 ** (-3.49 + 0.91 * r["m"]), 4), rel=1e-12)


# --- fires -------------------------------------------------------------------------


def pixel_row(**changes):
    row = dict(latitude="10.1", longitude="20.1", brightness="300.5", scan="1.0", track="1.5", acq_date="10-01-2025", acq_time="105", satellite="Aqua", instrument="MODIS", confidence="72", version="6", bright_t31="290.0", frp="4.2", daynight="N", type="0")
    return {**row, **changes}


def test_pixel_parsing_and_clusters(spark):
    rows = [
        pixel_row(),
        pixel_row(acq_time="30", satellite="Terra", frp="2.3"),
        pixel_row(confidence="29", frp="100"),
        pixel_row(type="2", frp="100"),
        pixel_row(frp="much"),
        pixel_row(scan="wide"),
        pixel_row(latitude="-7.9", longitude="-51.2", frp="4.9"),
        pixel_row(acq_date="99-99-2025", frp="7", brightness=None, scan=None),
    ]
    text = spark.createDataFrame(rows, schemas.MODIS_PIXEL_TEXT)
    parsed = fires.parse_pixels(text, fires.MODIS)
    assert sorted(r["reason"] for r in parsed.filter("reason IS NOT NULL").collect()) == ["frp", "scan"]
    good = parsed.filter("reason IS NULL").withColumn("row_no", F.monotonically_increasing_id())
    events = {r["event_id"]: r for r in fires.cluster_fires(good, fires.MODIS).collect()}
    assert set(events) == {"FIRMS-MODIS-10.00-20.00-10-01-2025", "FIRMS-MODIS-10.00-20.00-99-99-2025"}
    two = events["FIRMS-MODIS-10.00-20.00-10-01-2025"]
    assert (two["frp_mw"], two["pixel_count"], two["satellite"]) == (6.5, 2, "Terra")
    assert two["timestamp"] == "2025-01-10T00:30:00Z" and two["area_km2"] == 3.0
    assert two["magnitude"] == round(math.log10(7.5), 4)
    odd = events["FIRMS-MODIS-10.00-20.00-99-99-2025"]
    assert odd["timestamp"] == C.FALLBACK_FIRE_TIMESTAMP and odd["brightness_k"] == 0.0 and odd["area_km2"] == 1.5


def test_pixels_without_a_place_are_rejects(spark):
    rows = [pixel_row(frp="9"), pixel_row(latitude=None), pixel_row(longitude="NaN", frp="50"), pixel_row(acq_date=None), pixel_row(frp="much")]
    text = spark.createDataFrame(rows, schemas.MODIS_PIXEL_TEXT)
    assert [r["event_id"] for r in fires.fires_from_text(text, fires.MODIS).collect()] == ["FIRMS-MODIS-10.00-20.00-10-01-2025"]
    rejects = fires.fire_rejects(fires.parse_pixels(text, fires.MODIS))
    assert sorted(r["reason"] for r in rejects.collect()) == ["acq_date", "frp", "latitude", "longitude"]


def test_viirs_confidence_letters(spark):
    df = spark.createDataFrame([(c, 0) for c in ("l", " L ", "n", "H", "?", None)], "confidence string, type int")
    assert sorted(r["confidence_pct"] for r in fires.usable_pixels(df, fires.VIIRS).collect()) == [60, 60, 60, 90]


# --- hulls and floods ----------------------------------------------------------------


def brute_area(points):
    """Area from every edge that has all points on its left."""
    points = sorted(set(points))
    total = 0
    for p in points:
        for q in points:
            if p == q:
                continue
            cross = [(q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]) for r in points]
            outside = any(c == 0 and (r[0] - p[0]) * (r[0] - q[0]) + (r[1] - p[1]) * (r[1] - q[1]) > 0 for c, r in zip(cross, points))
            if min(cross) >= 0 and not outside:
                total += p[0] * q[1] - q[0] * p[1]
    return total / 2


def test_hull_area_against_brute_force(spark):
    rng = random.Random(5)
    groups = {g: [(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(1, 25))] for g in range(60)}
    groups[100] = [(3, 3)] * 5
    groups[101] = [(i, 2 * i) for i in range(9)]
    rows = [(g, float(y), float(x)) for g, pts in groups.items() for y, x in pts]
    df = spark.createDataFrame(rows, "g long, y double, x double").repartition(7)
    got = {r["g"]: r["hull_area"] for r in hull.hull_area(df, ["g"], "y", "x").collect()}
    assert got == {g: abs(brute_area(pts)) for g, pts in groups.items()}


def test_hull_leaves_out_points_without_a_position(spark):
    nan = float("nan")
    rows = [(1, 0.0, 0.0), (1, 0.0, 1.0), (1, 1.0, 0.0), (1, None, 5.0), (1, 9.0, None), (1, nan, 1.0), (2, None, 1.0), (3, nan, nan)]
    df = spark.createDataFrame(rows, "g long, y double, x double")
    assert {r["g"]: r["hull_area"] for r in hull.hull_area(df, ["g"], "y", "x").collect()} == {1: 0.5, 2: 0.0, 3: 0.0}


def test_hull_of_a_hot_group(spark):
    """One group holds nearly all rows; its hull is known."""
    hot = spark.range(200_000).select(
        F.lit(1).cast("long").alias("g"),
        (F.col("id") % 701).cast("double").alias("y"),
        (F.col("id") * 7919 % 503).cast("double").alias("x"),
    )
    cold = spark.createDataFrame([(2, 0.0, 0.0), (2, 0.0, 2.0), (2, 2.0, 0.0)], "g long, y double, x double")
    got = {r["g"]: r["hull_area"] for r in hull.hull_area(hot.union(cold), ["g"], "y", "x").collect()}
    assert got == {1: 700.0 * 502.0, 2: 2.0}


MARKS = "event_id long, latitude_dd double, longitude_dd double, elev_ft double, hwm_quality_id int, flag_date string, hwm_environment string, stateName string, waterbody string, eventName string, row_no long"


def mark(event_id, lat, lon, elev, quality_id, flag, row_no, env=None):
    return (event_id, lat, lon, elev, quality_id, flag, env, None, "W", "E", row_no)


def test_flood_rules(spark):
    rows = [
        # two poor marks only: left out
        mark(1, 1.0, 1.0, 5.0, 4, None, 1),
        mark(1, 1.0, 2.0, 5.0, 4, None, 2),
        # three poor marks: all of them count
        mark(2, 0.0, 0.0, 0.0, 4, "2024-05-01T00:00:00", 3),
        mark(2, 0.0, 1.0, 10.0, 4, "2024-05-02T00:00:00", 4, "Coastal"),
        mark(2, 1.0, 0.0, 20.0, 4, "someday", 5),
        # two good marks and a poor one: a point event
        mark(3, 0.0, 0.0, 0.0, 2, None, 6),
        mark(3, 0.0, 1.0, 0.0, 3, None, 7),
        mark(3, 5.0, 5.0, 0.0, 4, None, 8),
        # three equal good marks: area 0, not 1
        *[mark(4, 2.0, 2.0, 0.0, 2, None, 9 + i) for i in range(3)],
    ]
    marks = floods.parse_marks(spark.createDataFrame(rows, MARKS))
    out = {r["flood_event_id"]: r for r in floods.flood_events(marks).collect()}
    assert set(out) == {2, 3, 4}
    lat = 1 / 3
    area = 0.5 * 111.0 * 111.0 * math.cos(math.radians(lat))
    depth = min(5.0, 10.0 * 0.3048 / 2)
    assert out[2]["area_km2"] == round(area, 4)
    assert out[2]["fmi"] == round(0.5 * math.log10(area + 1) + 0.3 * depth + 0.2 * math.log10(25), 4)
    assert (out[2]["timestamp"], out[2]["duration_hours"], out[2]["quality"]) == ("2024-05-01T00:00:00Z", 24.0, "Poor")
    assert out[2]["environment"] == "Riverine" and out[2]["event_id"] == "USGS-FLOOD-2"
    assert (out[3]["area_km2"], out[3]["latitude"], out[3]["longitude"]) == (1.0, 0.0, 0.5)
    assert out[3]["timestamp"] == C.FALLBACK_FLOOD_TIMESTAMP and out[3]["duration_hours"] == 24.0
    assert out[4]["area_km2"] == 0.0


def test_marks_without_a_value_are_rejects(spark):
    rows = [mark(1, 0.0, 0.0, 1.0, 2, None, 1), mark(1, None, 0.0, 1.0, 2, None, 2), mark(1, 0.0, 1.0, None, 2, None, 3), mark(2, 0.0, 0.0, 1.0, None, None, 4)]
    marks = floods.parse_marks(spark.createDataFrame(rows, MARKS))
    assert [(r["flood_event_id"], r["hwm_count"]) for r in floods.flood_events(marks).collect()] == [(1, 1)]
    assert sorted(r["reason"] for r in floods.flood_rejects(marks).collect()) == ["elev_ft", "hwm_quality_id", "latitude_dd"]


# --- places -----------------------------------------------------------------------------


def brute_nearest(lat, lon, cities):
    cells = {}
    for y, x, cc in cities:
        cells.setdefault((int(y), int(x)), []).append((y, x, cc))
    for ring in (1, 2, 3):
        found = [
            c
            for i in range(-ring, ring + 1)
            for j in range(-ring, ring + 1)
            for c in cells.get((int(lat) + i, int(lon) + j), [])
        ]
        if found:
            return min(found, key=lambda c: (c[0] - lat) ** 2 + (c[1] - lon) ** 2)[2]
    return ""


@pytest.mark.parametrize("chunk", [2048, 3, 1])
def test_nearest_city_against_brute_force(spark, chunk):
    rng = random.Random(11)
    grid = lambda lo, hi: rng.randint(lo * 8, hi * 8) / 8
    cities = [(grid(-12, 12), grid(-12, 12), f"C{i}") for i in range(70)]
    cities += [(grid(3, 4), grid(3, 4), f"D{i}") for i in range(60)]  # a crowded cell, with repeats
    points = list({(grid(-18, 18), grid(-18, 18)) for _ in range(1500)})
    gaz = spark.createDataFrame([(i, *c) for i, c in enumerate(cities)], schemas.GAZETTEER)
    df = spark.createDataFrame(points, "latitude double, longitude double")
    out = places.nearest_city(df, gaz, chunk_cities=chunk).collect()
    assert len(out) == len(points)
    wrong = [(r, brute_nearest(r["latitude"], r["longitude"], cities)) for r in out if r["cc"] != brute_nearest(r["latitude"], r["longitude"], cities)]
    assert not wrong
    assert any(r["cc"] == "" for r in out)


def test_names_and_defaults(spark):
    rows = [(35.6, 139.7, "JP"), (1.3, 103.8, "SG"), (11.8, -15.6, "GW"), (-5.0, -20.0, ""), (0.0, 0.0, "XK")]
    df = spark.createDataFrame(rows, "latitude double, longitude double, cc string")
    got = {r["cc"]: (r["country"], r["region"]) for r in places.with_place(df).collect()}
    assert got == {
        "JP": ("Japan", "East Asia"),
        "SG": ("SG", "Southeast Asia"),
        "GW": ("Guinea-Bissau", "North West Hemisphere"),
        "": ("Unknown", "South West Hemisphere"),
        "XK": ("XK", "North East Hemisphere"),
    }


# --- documents and picks -------------------------------------------------------------------


def test_document_round_trip(spark):
    events = spark.createDataFrame([("abc-123", "earthquake", "HIGH", -6.251812, 119.820412, "2024-10-03T18:52:09Z", "2026-02-24T10:50:41Z", "GeoNet")], "event_id string, event_type string, severity_level string, latitude double, longitude double, event_time string, processed_at string, source string")
    doc = documents.to_document(events)
    row = doc.first()
    assert row["_id"] == "abc-123" and row["location"]["coordinates"] == [119.820412, -6.251812]
    assert row["event_time"] == dt.datetime(2024, 10, 3, 18, 52, 9)
    assert not {"event_id", "latitude", "longitude"} & set(doc.columns)
    back = documents.flatten_document(doc).first()
    assert (back["event_id"], back["latitude"], back["longitude"]) == ("abc-123", -6.251812, 119.820412)


def test_lost_location_sits_at_origin(spark):
    doc = spark.createDataFrame([("a", None)], "_id string, location struct<type:string,coordinates:array<double>>")
    row = documents.flatten_document(doc).first()
    assert (row["latitude"], row["longitude"]) == (0.0, 0.0)


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "id string, n int")
    assert sorted(tuple(r) for r in ranking.keep_one(df, "id", ["n"], "first").collect()) == [("a", 1), ("b", 5)]
    assert sorted(tuple(r) for r in ranking.keep_one(df, "id", ["n"], "last").collect()) == [("a", 3), ("b", 5)]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("x", 1, "c", 2.0), ("x", 1, "a", 3.0), ("x", 1, "b", 1.0), ("x", 1, None, 9.0)]
    for keep, want in (("first", None), ("last", "c")):
        for turned in (rows, rows[::-1]):
            frame = spark.createDataFrame(turned, "id string, n int, s string, v double").repartition(2)
            assert ranking.keep_one(frame, "id", ["n"], keep).first()["s"] == want


def test_strata_without_a_target_stay_whole(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") < 60, "a").when(F.col("id") < 80, "b").alias("s"))
    got = ranking.stratified_cap(df, ["s"], F.when(F.col("s") == "a", F.lit(7)))
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 7, "b": 20, None: 20}


def test_rank_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 3).alias("k"))
    plan = ranking.first_n_per(df, ["k"], ["n"], 5, "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("target", [0, 1, 50, 1000, 10**6])
def test_stratified_cap_is_exact(spark, target):
    df = spark.range(6000).select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") < 5000, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("s"),
    )
    got = ranking.stratified_cap(df, ["s"], F.lit(target))
    counts = {r["s"]: r["count"] for r in got.groupBy("s").count().collect()}
    full = {"hot": 5000, **{f"c{i}": 250 for i in range(4)}}
    assert counts == {s: min(n, target) for s, n in full.items() if min(n, target)}
    again = ranking.stratified_cap(df.repartition(3), ["s"], F.lit(target))
    assert got.exceptAll(again).count() == 0
