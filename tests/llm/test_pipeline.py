import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import TABLES, compare
from hazardry.llm.queries import QUERIES, TWINS
from test_decontaminate import brute as contaminated
from test_simhash import brute as near
from helpers import docs_frame, lower


def test_registered():
    assert {"pipeline", *QUERIES} <= set(queries()) and set(TWINS) <= set(oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", list(TWINS))
def test_twin(spark, tables, name):
    import duckdb

    duck = duckdb.connect()
    for table in TABLES.split():
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    assert compare(spark, duck, tables, name).startswith("OK")


def test_stages_against_brute_force(spark, tables):
    """Each stage on what the one before kept, on the smallest tables."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, tables).cache()
        after = {r["doc_id"] for r in docs.collect()}
        if name != "encoding":
            assert docs.columns == columns
        if name == "exact_dedup":
            best = {}
            for doc_id, text in before:
                best[lower(text)] = max(doc_id, best.get(lower(text), doc_id))
            assert after == set(best.values())
        if name == "near_dedup":
            assert after == {r[2] for r in near(before)}
        if name == "decontamination":
            assert after == {r[0] for r in contaminated(before, items) if not r[5]}
        if name == "encoding":
            assert after == {d for d, _ in before} and docs.filter("not round_trip").count() == 0
        kept.append(len(after))
    assert kept == sorted(kept, reverse=True) and kept[-1] > 50
    assert corpus_pipeline.run(spark, tables).count() == kept[-1]


def test_empty_documents(spark, tables):
    docs = docs_frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0
