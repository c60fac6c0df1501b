from collections import Counter
from itertools import product
from zlib import crc32

import pyarrow.parquet as pq
import pytest

from helpers import docs_frame
from hazardry.llm import hilbert as H
from pyspark.sql import functions as F


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_unit_steps(spark, dims, bits):
    cells = list(product(range(1 << bits), repeat=dims))
    frame = spark.createDataFrame(cells, [f"c{k}" for k in range(dims)])
    rows = frame.withColumn("at", H.curve_index([F.col(f"c{k}").cast("int") for k in range(dims)], bits)).collect()
    path = [tuple(r)[:dims] for r in sorted(rows, key=lambda r: r["at"])]
    assert sorted(r["at"] for r in rows) == list(range(len(cells)))
    assert path[0] == (0,) * dims
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


def rows_of(n):
    return [(i, f"text {i % 7} " + "ab " * (i % 50), ("en", "de", None)[i % 3], f"src{min(i % 20, 5)}", 1) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 5, 8, 9, 203])
def test_rows_law_and_slots(spark, n):
    rows = rows_of(n)
    got = H.hilbert_shards(docs_frame(spark, rows)).collect()
    assert len(got) == n
    counts = Counter(r["shard"] for r in got)
    assert all(0 <= s < 8 for s in counts)
    assert n < 8 or max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == crc32(text[r["doc_id"]].encode())
        assert r["law"] == "rows" and r["grown_shard"] is None
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in got)


def test_nulls_repeats_and_hot_values(spark):
    rows = [(1, None, None, None, None)] * 3 + [(None, "é" * 10, "fr", "src1", 10)] * 2 + [(i, "same", "en", "hot", 4) for i in range(60)]
    got = H.hilbert_shards(docs_frame(spark, rows)).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 65 and max(counts.values()) - min(counts.values()) <= 1
    assert sorted(r["size"] for r in got)[:3] == [1, 1, 1] and max(r["size"] for r in got) == 21


def test_runs_cover_small_boxes(spark):
    """A run spans fewer sources than a run of the table's own order does."""
    rows = [(i, "ab " * (1 + i * 7 % 90), ("en", "de", "fr", "es")[i * 5 % 4], f"src{i * 3 % 16:02d}", 1) for i in range(800)]
    shards = {r["doc_id"]: r["shard"] for r in H.hilbert_shards(docs_frame(spark, rows)).collect()}
    boxes = sum(len({r[k] for r in rows if shards[r[0]] == s}) for s in range(8) for k in (2, 3))
    assert boxes < 8 * 20 * 0.8


def test_written_runs_are_skipped_by_filters_on_several_dimensions(spark, tmp_path):
    """Footers alone tell which files a filter on two columns can leave out."""
    rows = [(i, "ab " * (1 + i * 7 % 90), ("en", "de", "fr", "es")[i * 5 % 4], f"src{i * 3 % 16:02d}", 1) for i in range(800)]
    rows += [(3, rows[3][1], "de", "src09", 1)] * 2 + [(None, None, None, None, None), (900, "", "en", None, 2)]
    docs = docs_frame(spark, rows)
    path = str(tmp_path / "runs")
    H.write_shards(docs, path, shards=32)
    back = spark.read.parquet(path)
    assert set(back.columns) - set(docs.columns) == {"shard", "size"}
    same = [tuple(r) for r in back.select(*docs.columns).collect()]
    assert Counter(map(str, same)) == Counter(str(tuple(r)) for r in docs.collect())
    counts = Counter(r["shard"] for r in back.collect())
    assert len(counts) == 32 and max(counts.values()) - min(counts.values()) <= 1
    boxes = []
    for file in (tmp_path / "runs").rglob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        box = {}
        for g in range(footer.num_row_groups):
            for c in range(footer.num_columns):
                column = footer.row_group(g).column(c)
                if column.path_in_schema in ("lang", "source", "size") and column.statistics.has_min_max:
                    low, high = box.get(column.path_in_schema, (column.statistics.min, column.statistics.max))
                    box[column.path_in_schema] = (min(low, column.statistics.min), max(high, column.statistics.max))
        boxes.append(box)

    def read(**wanted):
        return sum(all(b.get(k, (v, v))[0] <= v <= b.get(k, (v, v))[1] for k, v in wanted.items()) for b in boxes)

    assert len(boxes) >= 32
    for lang, source in product(("en", "de", "fr", "es"), ("src02", "src09", "src14")):
        assert read(lang=lang, source=source) <= len(boxes) / 3
        assert read(lang=lang, source=source, size=31) <= len(boxes) / 4


def test_written_runs_of_clashing_names_and_no_rows(spark, tmp_path):
    docs = docs_frame(spark, rows_of(40)).withColumn("shard", F.lit("mine")).withColumn("__row", F.lit(1)).withColumn("size", F.lit(2))
    H.write_shards(docs, str(tmp_path / "runs"), shards=4)
    back = spark.read.parquet(str(tmp_path / "runs"))
    assert back.count() == 40 and set(back.columns) == {*docs.columns, "_shard", "_size"}
    assert {r["shard"] for r in back.collect()} == {"mine"}
    H.write_shards(docs.limit(0), str(tmp_path / "none"), shards=4)


def test_rank_codes_against_counting(spark):
    values = [None, "a", "a", "b", "c", "c", "c", "d"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: r["code"] for r in H.rank_codes(frame, "v", len(values), bits=3).collect()}
    assert got == {None: 0, "a": 1, "b": 3, "c": 4, "d": 7}
