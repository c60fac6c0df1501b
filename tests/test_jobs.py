"""Stored tables, whole jobs and streams."""

import math

import pytest
from pyspark.sql import functions as F

from hazardry import constants as C
from hazardry import schemas
from hazardry.functions import geo
from hazardry.operators import analytics, mapview, search, processing
from hazardry.operators import star as S, processing
from hazardry.plans import warehouse as W
from hazardry.plans.keyset import KeySet
from hazardry.sources import docstore, readers, sinks, workspace
from hazardry.sources.workspace import fresh_folder, scratch
from hazardry.streaming import jobs

CLASSIFIED = "event_id string, event_type string, severity_level string, latitude double, longitude double, event_time timestamp, source string"


def some_events(spark, n=4000, offset=0):
    i = F.col("id") + offset
    return spark.range(n).select(
        F.concat(F.lit("E"), i.cast("string")).alias("event_id"),
        F.element_at(F.array(*[F.lit(k) for k in C.EVENT_TYPES]), (i % 4 + 1).cast("int")).alias("event_type"),
        F.element_at(F.array(*[F.lit(k) for k in C.SEVERITY_LEVELS]), (i % 3 + 1).cast("int")).alias("severity_level"),
        # a third of all events happen in one place
        F.when(i % 3 == 0, 10.5).otherwise((i * 7 % 1200 - 600) / 10.0).cast("double").alias("latitude"),
        F.when(i % 3 == 0, 20.5).otherwise((i * 13 % 3000 - 1500) / 10.0).cast("double").alias("longitude"),
        F.timestamp_seconds(F.lit(946684800) + i * 86400).alias("event_time"),
        F.lit("S").alias("source"),
    )


@pytest.fixture(scope="module")
def cities(spark):
    rows = [(i, float(lat), float(lon), "JP" if lat > 0 else "BR") for i, (lat, lon) in enumerate((a, b) for a in range(-60, 60, 4) for b in range(-150, 150, 4))]
    return spark.createDataFrame(rows, schemas.GAZETTEER)


@pytest.fixture(scope="module")
def star(spark, cities):
    store = W.Warehouse(spark, fresh_folder(spark, "test-star"))
    store.load(some_events(spark), cities)
    return store.open()


def test_load_is_idempotent(spark, cities):
    store = W.Warehouse(spark, fresh_folder(spark, "test-load"))
    assert store.load(some_events(spark, 300), cities) == {"received": 300, "inserted": 300, "skipped": 0, "errors": 0}
    assert store.load(some_events(spark, 400, 100), cities) == {"received": 400, "inserted": 200, "skipped": 200, "errors": 0}
    assert store.load(some_events(spark, 500), cities)["inserted"] == 0
    star = store.open()
    assert star.fact.count() == star.fact.select("event_id").distinct().count() == 500
    for dim, key in ((star.location, "location_id"), (star.time, "time_id"), (star.event_type, "event_type_id")):
        assert dim.count() == dim.select(key).distinct().count()
    joined = star.with_dimensions(star.fact, location=True, time=True, event_type=True)
    assert joined.count() == 500


def test_second_load_of_a_broken_one_counts_anew(spark, cities):
    """A load that dies after its facts leaves no counts; they are not used, and the next load mends them."""
    store = W.Warehouse(spark, fresh_folder(spark, "test-broken"))
    store.load(some_events(spark, 300), cities)
    append = W.Warehouse._append

    def dies(self, rows, name, *partition_by):
        if name == "counts":
            raise RuntimeError("lost")
        append(self, rows, name, *partition_by)

    W.Warehouse._append = dies
    try:
        with pytest.raises(RuntimeError):
            store.load(some_events(spark, 500), cities)
    finally:
        W.Warehouse._append = append
    assert store.open().counts is None
    total = lambda: analytics.event_summary(store.open()).filter("dimension = 'total'").first()["event_count"]
    assert total() == 500
    assert store.load(some_events(spark, 500), cities)["inserted"] == 0
    assert store.open().counts.agg(F.sum("event_count")).first()[0] == 500 == total()
    kept = store.open().pyramid.groupBy("kind", "zoom").agg(F.sum("event_count").alias("n")).collect()
    assert len(kept) == 2 * len(C.PYRAMID_ZOOMS) and {r["n"] for r in kept} == {500}


def test_kept_counts_equal_the_facts(star):
    kept = {tuple(r) for r in star.counts.groupBy("year", "event_type_id", "severity_level").agg(F.sum("event_count")).collect()}
    assert kept == {tuple(r) for r in S.counts_of(star.fact).collect()}
    files = analytics.event_summary(star, "2001-01-01", "2003-12-31").inputFiles()
    assert files and all("/counts/" in f for f in files)
    for span in (("2001-01-01", "2003-12-31"), ("2001-01-02", "2003-12-31"), (None, "2003-12-31")):
        rows = analytics.event_summary(star, *span, ["fire"]).filter("dimension = 'total'").collect()
        assert rows[0]["event_count"] == star.facts(*span, ["fire"]).count()


def test_new_ids_read_no_stored_id(spark, cities, monkeypatch):
    """A load of new events never opens the stored ids; one that repeats some opens only folders it needs."""
    store = W.Warehouse(spark, fresh_folder(spark, "test-filter"))
    store.load(some_events(spark, 300), cities)
    read, opened = KeySet.stored, []
    unseen = KeySet.unseen

    def watched(self, rows, key, area):
        monkeypatch.setattr(KeySet, "stored", lambda s: opened.append(key) or read(s))
        out = unseen(self, rows, key, area)
        monkeypatch.setattr(KeySet, "stored", read)
        return out

    monkeypatch.setattr(KeySet, "unseen", watched)
    assert store.load(some_events(spark, 400, 300), cities)["inserted"] == 400
    assert "event_id" not in opened
    assert store.load(some_events(spark, 10, 695), cities)["inserted"] == 5 and "event_id" in opened
    assert store.open().fact.count() == 705 == store.keys("fact").stored().select("key").distinct().count()


@pytest.mark.parametrize("first_rows", [1, 64])
def test_key_set_equals_an_anti_join(spark, first_rows):
    """Whatever the filters let through: also when they are full of ones, and when they grow and are combined."""
    keys = KeySet(spark, fresh_folder(spark, "test-keys"), first_rows)
    ids = lambda low, high: spark.range(low, high).selectExpr("concat('E', id) as event_id", "id")
    new = lambda: sorted(r["id"] for r in keys.unseen(ids(300, 900), "event_id", area).collect())
    with scratch(spark, "test") as area:
        assert new() == list(range(300, 900))
        for low in range(0, 600, 150):
            keys.add(ids(low, low + 150), "event_id")
            assert new() == list(range(max(300, low + 150), 900))
        made = keys._generation()
        assert (made[0] > 0) == (first_rows == 1) and keys.filters().count() <= 2 * made[1] * 8
        plan = keys.unseen(ids(10_000, 10_100), "event_id", area)._jdf.queryExecution().executedPlan().toString()
        assert "parquet" not in plan.lower()
        full = keys.filters().select("block", *[F.lit(-1).cast("long").alias(f"word{i}") for i in range(4)], "bucket")
        every = keys._filter_rows(ids(0, 2000).withColumnRenamed("event_id", "key"), made[1])
        full = full.unionByName(every.select("block", *[F.lit(-1).cast("long").alias(f"word{i}") for i in range(4)], "bucket"))
        keys._write_filter(area.staged(full), *made)
        assert keys.possible(ids(300, 900), "event_id").count() == 600 and new() == list(range(600, 900))
        keys.rebuild(ids(0, 400), "event_id")
        assert new() == list(range(400, 900)) and keys.stored().count() == 400


def test_stored_keys_are_read_around_their_hash(spark):
    keys = KeySet(spark, fresh_folder(spark, "test-place"))
    keys.add(spark.range(5000).selectExpr("concat('E', id) as event_id"), "event_id")
    with scratch(spark, "test") as area:
        plan = keys.unseen(spark.createDataFrame([("E7",)], "event_id string"), "event_id", area)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1]
    assert "EqualTo(place," in plan or "In(place," in plan


def cells_of(frame):
    return {(r["cell_lat"], r["cell_lon"], r["event_type_id"]): (r["lat_sum"], r["lng_sum"], r["event_count"]) for r in frame.collect()}


@pytest.mark.parametrize(
    "box, start, end",
    [
        ((-90, 90, -180, 180), "1980-01-01", "2030-01-01"),
        ((-33.3, 41.7, -77.1, 120.4), "2001-02-11", "2009-11-30"),
        ((-60, 60, -150, 150), "2003-03-01", "2003-03-31"),
        ((10.4, 10.6, 20.4, 20.6), "2000-01-01", "2010-12-31"),
        ((0.0, 40.0, 0.0, 60.0), "2005-06-10", "2005-06-20"),
    ],
)
def test_map_cells_from_the_pyramid(spark, star, box, start, end):
    """Whole cells of whole months come from the pyramid, the rest from facts: the same cells as from facts alone."""
    for kind, sizes in (("square", C.SQUARE_CELL_DEGREES), ("pre", C.PRE_CELL_DEGREES)):
        for zoom in (2, 4, 6, 9):
            frame = mapview.map_cells(star, kind, zoom, box, start, end)
            got, want = cells_of(frame), cells_of(mapview.grid_cells(star.facts(start, end, box=box), sizes[zoom]))
            assert got.keys() == want.keys()
            for cell, sums in want.items():
                assert got[cell] == pytest.approx(sums, abs=1e-7) and got[cell][2] == sums[2]
            if zoom < 9 and box == (-90, 90, -180, 180):
                assert any("/pyramid/" in f for f in frame.inputFiles())
    total = mapview.map_total(star, box, start, end, 5).first()["total"]
    assert total == star.facts(start, end, box=box).count()


def test_whole_months():
    assert mapview._whole_months("2001-01-01", "2008-12-31") == (200101, 200812)
    assert mapview._whole_months("2001-01-02", "2008-12-30") == (200102, 200811)
    assert mapview._whole_months("2004-02-01", "2004-02-29") == (200402, 200402)
    low, high = mapview._whole_months("2004-02-02", "2004-02-28")
    assert low > high


def test_new_types_get_numbers(spark):
    store = W.Warehouse(spark, fresh_folder(spark, "test-types"))
    events = some_events(spark, 40)
    store.load(events.withColumn("event_type", F.when(F.col("event_type") == "flood", "tsunami").otherwise(F.col("event_type"))))
    store.load(some_events(spark, 40, 40).withColumn("event_type", F.lit("avalanche")))
    store.load(some_events(spark, 40, 80).withColumn("event_type", F.lit("tsunami")))
    star = store.open()
    assert star.types == S.FIXED_TYPES | {"tsunami": 5, "avalanche": 6}
    counts = {r["event_type"]: r["event_count"] for r in analytics.event_counts(star).collect()}
    assert counts == {"earthquake": 10, "fire": 10, "storm": 10, "tsunami": 50, "avalanche": 40}
    joined = star.with_dimensions(star.fact, location=True, time=True, event_type=True)
    assert joined.filter("event_type = 'tsunami'").count() == 50
    assert star.facts(event_types=["avalanche"]).count() == 40 and star.facts(event_types=["nothing"]).count() == 0


def test_nothing_is_left_of_a_load(spark, cities):
    from pathlib import Path

    folder = fresh_folder(spark, "test-scratch")
    W.Warehouse(spark, folder).load(some_events(spark, 50), cities)
    assert not list(Path(folder).parent.glob("load-*"))


def test_star_queries_read_facts_alone(star):
    box = (0.0, 40.0, 10.0, 60.0)
    plans = [
        search.search_events(star, country="Japan", lat=10.0, lng=20.0),
        mapview.map_hex(star, box, 5, "2000-01-01", "2010-01-01"),
        mapview.map_points(star, box, "2000-01-01", "2010-01-01"),
        analytics.top_locations(star),
        analytics.monthly_trends(star, country="Japan"),
    ]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and all("/fact/" in f for f in frame.inputFiles())
    assert "cell_id" in plans[1]._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_row_groups_are_skipped_by_box(spark, tmp_path):
    """With facts in order of month and cell, a small box leaves most row groups unread."""
    import pyarrow.parquet as pq

    facts = S.fact_rows(S.decompose(some_events(spark, 20_000)))
    month = F.expr("time_id div 10000")
    facts = facts.filter("year < 2002").coalesce(1).sortWithinPartitions(month, "cell_id")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "2048")
    try:
        facts.write.parquet(str(tmp_path / "f"))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    file = pq.ParquetFile(next((tmp_path / "f").glob("part-*")))
    at = file.schema_arrow.names.index("cell_id")
    spans = [file.metadata.row_group(k).column(at).statistics for k in range(file.num_row_groups)]
    cell = (30 + 90) * 400 + 30 + 180
    touched = sum(s.min <= cell + 400 and s.max >= cell for s in spans)
    assert len(spans) > 5 and touched < len(spans)


def test_first_row_of_an_id_wins(spark):
    store = W.Warehouse(spark, fresh_folder(spark, "test-first"))
    rows = [
        ("a", "fire", "LOW", 1.0, 2.0, 200, "late"),
        ("a", "fire", "HIGH", 1.0, 2.0, 100, "early"),
        (None, "fire", "HIGH", 1.0, 2.0, 100, "no id"),
        ("b", None, "HIGH", 1.0, 2.0, 100, "no type"),
        ("c", "fire", "HIGH", None, 2.0, 100, "nowhere"),
        ("d", "fire", "HIGH", float("nan"), 2.0, 100, "not a number"),
    ]
    events = spark.createDataFrame(rows, CLASSIFIED.replace("timestamp", "long")).withColumn("event_time", F.timestamp_seconds("event_time"))
    assert store.load(events) == {"received": 6, "inserted": 1, "skipped": 1, "errors": 4}
    star = store.open()
    assert star.fact.first()["source"] == "early"
    assert star.location.first()["country"] == "Unknown" and star.location.first()["region"] == "North East Hemisphere"


def test_date_parts(spark):
    events = spark.createDataFrame([("t", "earthquake", "HIGH", 35.6, 139.7, "2024-11-15 08:30:00", "USGS")], CLASSIFIED.replace("timestamp", "string")).withColumn("event_time", F.col("event_time").cast("timestamp"))
    row = S.decompose(events).first()
    assert (row["day"], row["month"], row["year"], row["hour"]) == (15, 11, 2024, 8)
    assert S.fact_rows(S.decompose(events)).first()["time_id"] == 2024111508


def test_totals_agree(star):
    n = star.fact.count()
    counts = {r["event_type"]: r["event_count"] for r in analytics.event_counts_with_total(star).collect()}
    assert counts.pop("TOTAL") == n == sum(counts.values())
    assert sum(r["event_count"] for r in analytics.monthly_trends(star).collect()) == n
    summary = analytics.event_summary(star).groupBy("dimension").sum("event_count").collect()
    assert {r[1] for r in summary} == {n}
    assert sum(r["event_count"] for r in analytics.top_locations(star, 10**6).collect()) == n


def test_date_filter_is_pushed_into_the_fact_scan(star):
    plan = analytics.event_summary(star, "2001-02-03", "2003-04-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time_id,2001020300)" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert plan.count("FileScan") == 1  # the fact alone: no filter or column needs a dimension


def test_country_filter(star):
    japan = analytics.event_summary(star, country="jApAn").filter("dimension = 'total'").first()["event_count"]
    joined = star.with_dimensions(star.fact, location=True)
    assert japan == joined.filter("country = 'Japan'").count() > 0


def test_pages_cover_the_result(star):
    filters = dict(start_date="2001-01-01", event_types=["fire", "flood"], region="asia")
    pages = [search.search_events(star, limit=70, offset=o, **filters).collect() for o in range(0, 2000, 70)]
    rows = [r for page in pages for r in page]
    assert len(rows) == len({r["event_id"] for r in rows}) == rows[0]["total"] == search.matching_total(star, **filters).first()[0]
    keys = [(r["event_time"], r["event_id"]) for r in rows]
    assert [k[0] for k in keys] == sorted((k[0] for k in keys), reverse=True)


def test_keyset_pages_equal_offset_pages(star):
    whole = search.search_events(star, limit=300).collect()
    rows = whole[:100]
    for _ in range(2):
        rows += search.search_after(star, rows[-1]["event_time"], rows[-1]["event_id"], 100).collect()
    assert rows == whole


def test_total_of_an_empty_page(star):
    assert search.search_events(star, limit=5, offset=10**5).count() == 0
    assert search.matching_total(star).first()["total"] == star.fact.count()


def test_map_tables_by_zoom(star):
    world = (-90.0, 90.0, -180.0, 180.0)
    for zoom in range(2, 10):
        rows = mapview.map_hex(star, world, zoom, "1980-01-01", "2030-01-01").collect()
        least, cap = C.MIN_CLUSTER_COUNT.get(zoom, 0), C.MAX_CLUSTERS_PER_TYPE[zoom]
        assert rows and min(r["event_count"] for r in rows) >= least
        for kind in C.EVENT_TYPES:
            assert sum(r["event_type"] == kind for r in rows) <= cap
    whole = mapview.map_hex(star, world, 9, "1980-01-01", "2030-01-01", min_count=0, cap=10**9)
    assert whole.agg(F.sum("event_count")).first()[0] == star.fact.count()


def test_map_mode_switch_and_checks(star):
    assert "total_count" not in mapview.map_view(star, -50, 50, -100, 100, 9).columns
    box, years = (-50, 50, -100, 100), ("1980-01-01", "2030-01-01")
    modes = {z: mapview.map_total(star, box, *years, z).first() for z in (9, 10)}
    assert [modes[z]["mode"] for z in (9, 10)] == ["clusters", "points"]
    assert modes[9]["total"] == modes[10]["total"] == star.facts(*years, box=box).count() > 0
    assert mapview.map_total(star, (-89.9, -89.8, 0, 1), *years, 5).first()["total"] == 0
    points = mapview.map_view(star, -50, 50, -100, 100, 10).collect()
    assert len(points) == C.MAP_POINT_LIMIT < points[0]["total_count"]
    with pytest.raises(ValueError):
        mapview.map_view(star, 50, -50, -100, 100, 5)
    with pytest.raises(ValueError):
        mapview.map_view(star, -50, 50, -100, 100, 5, "2020-01-02", "2020-01-01")


def test_near_is_a_square(spark):
    df = spark.createDataFrame([(4.5, 4.5), (4.51, 0.0)], "lat double, lon double")
    assert df.filter(geo.near(F.col("lat"), F.col("lon"), 0.0, 0.0, 4.5 * 111.0)).count() == 1


def test_yearly_targets(spark):
    df = spark.createDataFrame([(k, y) for k in C.YEARLY_TARGETS for y in range(1975, 2031)], "k string, y int")
    for r in df.select("k", "y", analytics.yearly_target(F.col("k"), F.col("y")).alias("t")).collect():
        points = sorted(C.YEARLY_TARGETS[r["k"]].items())
        year = min(max(r["y"], points[0][0]), points[-1][0])
        (y0, v0), (y1, v1) = next((a, b) for a, b in zip(points, points[1:]) if a[0] <= year <= b[0])
        assert r["t"] == round(v0 + (year - y0) / (y1 - y0) * (v1 - v0))


# --- document store ------------------------------------------------------------------


def test_fields_absent_stay_and_nulls_written_win(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "_id string, n int, s string")
    new = spark.createDataFrame([("a", None, 1), ("c", 3, 1), ("c", 4, 2)], "_id string, n int, at int")
    got = {r["_id"]: (r["n"], r["s"], r["at"]) for r in docstore.upsert(old, new, "_id", ["at"]).collect()}
    assert got == {"a": (None, "x", 1), "b": (2, "y", None), "c": (4, None, 2)}


def batch_of(spark, rows):
    return spark.createDataFrame(rows, "_id string, n int, at int")


def held(spark, path):
    return sorted(map(tuple, docstore.read_documents(spark, path, batch_of(spark, []).schema).collect()))


def test_batches_rewrite_touched_folders(spark):
    """A batch changes its documents and its folders only; writing it again changes nothing."""
    from pathlib import Path

    path, schema = fresh_folder(spark, "test-store"), batch_of(spark, []).schema
    write = lambda rows: docstore.write_batch(batch_of(spark, rows), path, schema, ["at"])
    files = lambda: {f for f in Path(path).rglob("*.parquet")}
    write([(f"k{i}", i, 1) for i in range(200)])
    before = files()
    write([("k7", 70, 2), ("k7", 71, 3), ("new", 5, 1), (None, 9, 9)])
    after = held(spark, path)
    assert after == sorted([(f"k{i}", i, 1) for i in range(200) if i != 7] + [("k7", 71, 3), ("new", 5, 1)])
    folders = {f.parent.name for f in before - files()}
    assert 1 <= len(folders) <= 2 and {f.parent.name for f in files() - before} >= folders
    write([("k7", 70, 2), ("k7", 71, 3), ("new", 5, 1), (None, 9, 9)])
    assert held(spark, path) == after and len({f.parent for f in files()}) <= docstore.BUCKETS
    write([])
    docstore.write_batch(batch_of(spark, [("k7", 1, None)]).select("_id", "at"), path, schema, ["at"])
    assert ("k7", 71, None) in held(spark, path) and len(held(spark, path)) == 201


@pytest.mark.parametrize("whole", [True, False])
def test_a_writer_that_dies_is_finished_by_the_next(spark, monkeypatch, whole):
    from pathlib import Path

    path, schema = fresh_folder(spark, "test-dies"), batch_of(spark, []).schema
    docstore.write_batch(batch_of(spark, [("a", 1, 1), ("b", 1, 1)]), path, schema, ["at"])
    write = docstore._write

    def dies(rows, to, *args, **options):
        if options:
            raise RuntimeError("lost")
        write(rows, to, *args)

    monkeypatch.setattr(docstore, "_write", dies)
    with pytest.raises(RuntimeError):
        docstore.write_batch(batch_of(spark, [("a", 2, 2)]), path, schema, ["at"])
    monkeypatch.undo()
    if not whole:
        Path(f"{path}_pending/_SUCCESS").rename(f"{path}_pending/_partial")
    docstore.write_batch(batch_of(spark, [("b", 3, 3)]), path, schema, ["at"])
    assert held(spark, path) == [("a", 2, 2) if whole else ("a", 1, 1), ("b", 3, 3)]


def test_upsert_does_not_sort_the_store(spark):
    old = spark.range(1000).selectExpr("cast(id as string) as _id", "cast(id as int) as n", "1 as at")
    plan = docstore.upsert(old, batch_of(spark, [("1", 2, 2)]), "_id", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortAggregate" not in plan and "SortMergeJoin" not in plan


def test_upsert_report(spark):
    batch = lambda rows: batch_of(spark, rows)
    report = docstore.upsert_report(batch([("a", 1, 1), ("b", 1, 1)]), batch([("a", 2, 2), ("c", 1, 1), ("c", 2, 2), (None, 1, 1)]), "_id").first()
    assert report.asDict() == {"received": 4, "inserted": 1, "updated": 1, "repeated": 1, "errors": 1}


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from hazardry.sources import workspace

    def session(master):
        context = SimpleNamespace(master=master, applicationId=master)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))

    assert workspace.base_folder(session("local[4]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace.base_folder(session(master))


# --- sources and sinks ----------------------------------------------------------------


def test_missing_feeds_are_skipped(spark):
    folder = fresh_folder(spark, "test-feeds")
    rows = spark.createDataFrame([("a", "fire", 1.0, 2.0, 3.0, "2024-01-01T00:00:00Z", "S")], schemas.UNIFIED_EVENT)
    paths = sinks.write_unified(rows, folder)
    assert readers.union_feeds(spark, list(paths.values()), multi_line=False).count() == 1
    assert readers.union_feeds(spark, [folder + "-none"]).count() == 0
    raw = readers.raw_feeds(spark, folder)
    assert set(raw) == set(C.EVENT_TYPES) and raw["storm"].count() == 0


def test_canonical_files_per_hazard(spark, tmp_path):
    rows = spark.createDataFrame([("a", "fire"), ("b", "flood"), ("c", "fire")], "event_id string, event_type string")
    sinks.write_canonical({"fire": rows.filter("event_type = 'fire'"), "flood": rows.filter("event_type = 'flood'")}, str(tmp_path))
    found = {p.name: spark.read.json(str(p)).count() for p in tmp_path.iterdir() if not p.name.startswith((".", "_"))}
    assert sorted(found.values()) == [1, 2]


def test_multi_line_geojson(spark, tmp_path):
    text = '{"type": "FeatureCollection", "features": [\n {"id": "q", "properties": {"mag": 3, "time": 1},\n "geometry": {"type": "Point", "coordinates": [1, 2]}},\n {"id": "p", "properties": {"mag": "x"}, "geometry": {"type": "Point", "coordinates": [1, 2, 3]}}]}'
    path = tmp_path / "q.geojson"
    path.write_text(text)
    from hazardry.operators.adapters import adapt_quakes

    rows = adapt_quakes(readers.quake_features(spark, str(path))).collect()
    assert [(r["event_id"], r["depth_km"], r["review_status"]) for r in rows] == [("q", 0.0, "automatic")]


def test_topic_messages_round_trip(spark):
    rows = spark.createDataFrame([("a", "storm", 1.0, 2.0, 3.0, "t", "S")], schemas.UNIFIED_EVENT)
    message = sinks.topic_messages(rows)
    assert message.first()["topic"] == "storms-topic" and message.first()["key"] == "a"
    assert readers.parse_messages(message).first() == rows.first()


# --- streams ----------------------------------------------------------------------------


def test_stream_survives_unreadable_messages(spark, tmp_path):
    lines = ['{"event_id": "a", "event_type": "fire", "severity_raw": 60.0, "latitude": 1, "longitude": 2, "timestamp": "t", "source": "S"}', "not json", '{"event_id": "b"}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("\n".join(lines))
    messages = readers.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "value string").schema, "text")
    out = str(tmp_path / "out")
    jobs.append_files(jobs.process(jobs.ingest(messages)), out, str(tmp_path / "ck"), availableNow=True).awaitTermination()
    assert [r["event_id"] for r in spark.read.parquet(out).collect()] == ["a"]


def test_stream_resumes_after_its_checkpoint(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    events = spark.createDataFrame([("a", "fire", 60.0, 1.0, 2.0, "t", "S")], schemas.UNIFIED_EVENT)
    for step in (1, 2):
        events.withColumn("event_id", F.lit(str(step))).write.mode("append").parquet(source)
        stream = readers.file_stream(spark, source, schemas.UNIFIED_EVENT, "parquet")
        jobs.append_files(jobs.process(stream), out, checkpoint, availableNow=True).awaitTermination()
        assert spark.read.parquet(out).count() == step


def test_two_consumers_of_one_source(spark, tmp_path):
    """Each has its own checkpoint, so each sees every event, whenever it runs."""
    source = str(tmp_path / "in")
    events = spark.createDataFrame([(str(k), "fire", 6000.0 * k, 1.0, 2.0, "t", "S") for k in range(4)], schemas.UNIFIED_EVENT)
    for step, rows in enumerate((events.filter("event_id < '2'"), events.filter("event_id >= '2'")), start=1):
        rows.write.mode("append").parquet(source)
        for name in ("all", "alerts") if step == 2 else ("all",):
            processed = jobs.process(readers.file_stream(spark, source, schemas.UNIFIED_EVENT, "parquet"), "cm")
            run = jobs.critical_alerts if name == "alerts" else jobs.append_files
            run(processed, str(tmp_path / name), str(tmp_path / f"ck-{name}"), availableNow=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "alerts")).collect()) == ["2", "3"]


def test_streams_with_new_checkpoints_lose_nothing(spark, tmp_path):
    processed = jobs.process(spark.createDataFrame([("a", "fire", 60.0, 1.0, 2.0, "2024-01-01T00:00:00Z", "S")], schemas.UNIFIED_EVENT))
    from hazardry.operators.documents import to_document

    path = fresh_folder(spark, "test-streams")
    for k in range(2):
        source = str(tmp_path / f"in{k}")
        spark.createDataFrame([(f"e{k}", "fire", 60.0, 1.0, 2.0, "2024-01-01T00:00:00Z", "S")], schemas.UNIFIED_EVENT).write.parquet(source)
        stream = jobs.process(readers.file_stream(spark, source, schemas.UNIFIED_EVENT, "parquet"))
        jobs.upsert_documents(stream, path, str(tmp_path / f"ck{k}"), ["processed_at"], availableNow=True).awaitTermination()
    assert sorted(r["_id"] for r in docstore.read_documents(spark, path, to_document(processed).schema).collect()) == ["e0", "e1"]


def test_late_rows_are_counted(spark, tmp_path):
    source = tmp_path / "in"
    schema = "event_id string, t string"
    at = lambda rows: spark.createDataFrame(rows, schema).select("event_id", F.col("t").cast("timestamp").alias("event_time"))
    dropped = 0
    for rows in ([("a", "2024-01-02 00:00:00")], [("b", "2024-01-02 01:00:00")], [("old", "2024-01-01 00:00:00")]):
        at(rows).coalesce(1).write.mode("append").parquet(str(source))
        stream = jobs.live_events(readers.file_stream(spark, str(source), at(rows).schema, "parquet"), 2)
        query = jobs.append_files(stream, str(tmp_path / "out"), str(tmp_path / "ck"), availableNow=True)
        query.awaitTermination()
        dropped += jobs.late_rows(query)
    assert dropped == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_live_feed_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "event_id string, t string").select("event_id", F.col("t").cast("timestamp").alias("event_time"))
    df.write.parquet(source)
    stream = jobs.live_events(readers.file_stream(spark, source, df.schema, "parquet"))
    jobs.append_files(stream, str(tmp_path / "out"), str(tmp_path / "ck"), availableNow=True).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_distances_are_finite(star):
    assert all(math.isfinite(r["latitude"]) for r in star.location.collect())


def test_running_stats_over_batches_and_restarts(spark, tmp_path):
    schema = "event_id string, event_type string, severity_raw double, latitude double, longitude double, timestamp string, source string"
    rows = [
        (None if k % 11 == 0 else f"e{k}", ("fire", "storm", "volcano")[k % 3], None if k % 7 == 0 else k * 3.0, 1.0, 2.0, "2024-01-01T00:00:00Z", "s")
        for k in range(90)
    ]
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "stats", "checkpoint"))

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        jobs.running_stats(stream, path, checkpoint, "cm", availableNow=True).awaitTermination()

    for step in range(3):
        for part in range(2):
            at = step * 30 + part * 15
            spark.createDataFrame(rows[at : at + 15], schema).coalesce(1).write.mode("append").parquet(source)
        drain()
        got = {r["measure"]: r["value"] for r in jobs.read_stats(spark, path).collect()}
        seen = spark.createDataFrame(rows[: step * 30 + 30], schema)
        want = {r["measure"]: r["value"] for r in processing.processing_report(seen, "cm", "drop").collect()}
        assert got == want and got["received"] == step * 30 + 30
        assert len([p for p in (tmp_path / "stats").iterdir() if p.name.startswith("version=")]) == 2
    # the last batch runs again: its commit is lost, its version is written once more
    commits = sorted((int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()))
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    drain()
    assert {r["measure"]: r["value"] for r in jobs.read_stats(spark, path).collect()} == want


def test_first_per_outcome_does_not_sort(spark):
    events = spark.createDataFrame(
        [("b", "storm", 500.0, "2"), ("a", "storm", 500.0, "2"), ("c", "storm", 0.0, "1"), (None, "fire", 1.0, "0")],
        "event_id string, event_type string, severity_raw double, timestamp string",
    )
    first = processing.first_per_outcome(events, "cm", "drop")
    assert "Sort [" not in first._jdf.queryExecution().executedPlan().toString()
    got = {r["outcome"]: r["event_id"] for r in first.collect()}
    assert got["DROPPED"] is None and "a" in got.values() and "b" not in got.values()
    assert processing.first_per_outcome(events.limit(0), "cm", "drop").collect() == []


def test_pyramid_shuffles_facts_once(spark, star):
    """Every zoom is added up within the tasks of one range partitioning; a task's share is bounded."""
    rows = mapview.pyramid_rows(star.fact, [5])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan
    keys = ["kind", "zoom", "month", "cell_lat", "cell_lon", "event_type_id"]
    got = {tuple(r[:6]): r[6:] for r in mapview._added(rows, *keys).collect()}
    by_month = star.fact.withColumn("month", F.expr("cast(time_id div 10000 as int)"))
    want = {}
    for kind, (sizes, _) in mapview._SIZES.items():
        for zoom in C.PYRAMID_ZOOMS:
            for r in mapview.grid_cells(by_month, sizes[zoom], "month").collect():
                want[kind, zoom, r["month"], r["cell_lat"], r["cell_lon"], r["event_type_id"]] = r[4:]
    assert got.keys() == want.keys() and all(got[k][2] == want[k][2] and got[k] == pytest.approx(want[k], abs=1e-7) for k in want)


def test_load_in_many_ranges(spark, cities, monkeypatch):
    """Tasks of a few rows each load the same tables as one task does."""
    stores = []
    for most in (7, 500_000):
        monkeypatch.setattr(workspace, "ROWS_PER_TASK", most)
        store = W.Warehouse(spark, fresh_folder(spark, "test-ranges"))
        assert [store.load(some_events(spark, n), cities)["inserted"] for n in (60, 150, 150)] == [60, 90, 0]
        stores.append(store)
    few, one = [s.open() for s in stores]
    assert workspace.range_tasks(500_001) == [2] and not workspace.range_tasks(500_000)
    for name in ("fact", "location", "time", "counts"):
        a, b = getattr(few, name), getattr(one, name)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert sorted(map(str, stores[0].keys("fact").stored().collect())) == sorted(map(str, stores[1].keys("fact").stored().collect()))


def test_growing_keys_write_one_generation(spark, monkeypatch):
    """Keys that need larger filters do not get small ones first."""
    made, write = [], KeySet._write_filter
    monkeypatch.setattr(KeySet, "_write_filter", lambda self, rows, number, size: made.append((number, size)) or write(self, rows, number, size))
    keys = KeySet(spark, fresh_folder(spark, "test-one"), first_rows=4)
    rows = spark.range(2000).selectExpr("concat('E', id) as event_id")
    keys.add(rows, "event_id")
    assert len(made) == 1 and made[0][1] * 64 >= 2000
    assert keys.possible(rows, "event_id").count() == 2000


def test_a_stored_key_has_its_bits_in_one_row(spark):
    """Bits that two loads set for other keys do not make a key a possible one."""
    keys = KeySet(spark, fresh_folder(spark, "test-bits"))
    keys.add(spark.createDataFrame([("A",)], "event_id string"), "event_id")
    number, size = keys._generation()
    whole = keys._filter_rows(spark.createDataFrame([("B",)], "key string"), size)
    halves = [whole.withColumns({w: F.lit(0).cast("long") for w in words}) for words in (("word0", "word1"), ("word2", "word3"))]
    asked = spark.createDataFrame([("A",), ("B",), ("C",)], "event_id string")
    for half in halves:
        keys._write_filter(half, number, size)
    assert [r["key"] for r in keys.possible(asked, "event_id").collect()] == ["A"]
    keys.add(spark.createDataFrame([("B",)], "event_id string"), "event_id")
    assert sorted(r["key"] for r in keys.possible(asked, "event_id").collect()) == ["A", "B"]
