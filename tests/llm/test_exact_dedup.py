from collections import defaultdict
from hashlib import sha256

import pytest

from helpers import by_id, docs_frame, lower
from hazardry.llm import exact_dedup as E

ROWS = [
    (1, "Hello World"), (2, "hello world"), (3, "HELLO WORLD"), (4, "hello wörld"), (5, "hello wÖrld"), (6, None), (7, ""),
    (8, "x" * 200_000), (9, "X" * 200_000), (10, "hello world "), (None, "hello world"), (11, "only"), (11, "only"), (12, "twin"), (12, "Twin"),
    *[(100 + k, "many copies") for k in range(300)],
]


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out, seen = [], set()
    for doc_id, text in rows:
        key = lower(text)
        ids = [i for i in groups[key] if i is not None]
        keep = max(ids) if ids else None
        kept = doc_id == keep and (key, doc_id) not in seen
        seen.add((key, doc_id))
        out.append((doc_id, keep, len(groups[key]), kept, sha256(key.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0], str(r[1:])))


@pytest.mark.parametrize("capacity", [1, 3, 1 << 16])
def test_against_brute_force(spark, capacity):
    got = E.exact_duplicates(docs_frame(spark, ROWS), capacity=capacity)
    assert by_id(got, "keep_id", "group_size", "kept", "text_sha256") == expected(ROWS)


def test_colliding_keys_are_told_apart(spark, monkeypatch):
    """With every key equal all texts chain in one bucket and still only equal bytes are copies."""
    keyed = E._keyed
    monkeypatch.setattr(E, "_keyed", lambda docs: keyed(docs).withColumn("key", E.F.lit(7).cast("long")))
    got = E.exact_duplicates(docs_frame(spark, ROWS), capacity=2, most_bits=4)
    assert by_id(got, "keep_id", "group_size", "kept", "text_sha256") == expected(ROWS)
    index = E.build_index(docs_frame(spark, ROWS), capacity=2, most_bits=4)[0].collect()
    assert sorted(r["link"] for r in index) == list(range(1, len(index) + 1)) and {r["links"] for r in index} == {len(index)}


def test_documents_go_through_the_directory(spark, monkeypatch):
    """Slots taken out of the directory take their documents out of the result."""
    whole = E.build_index

    def cut(*args):
        index, directory, depth = whole(*args)
        return index, directory.filter("bucket > 0"), depth

    lost = [r["key"] for r in whole(docs_frame(spark, ROWS), 2)[0].filter("bucket = 0").collect()]
    everything = {r["text_sha256"] for r in E.exact_duplicates(docs_frame(spark, ROWS), capacity=2).collect()}
    monkeypatch.setattr(E, "build_index", cut)
    found = {r["text_sha256"] for r in E.exact_duplicates(docs_frame(spark, ROWS), capacity=2).collect()}
    assert lost and len(found) == len(everything) - len(lost)


def test_empty_table(spark):
    assert E.exact_duplicates(docs_frame(spark, [])).collect() == []


def test_directory_splits_and_doubles():
    counts = {p: 1 for p in range(64)} | {5: 30}
    buckets = E.grow_directory(counts, 6, 8)
    covered = [s for prefix, depth in buckets for s in range(prefix << (6 - depth), (prefix + 1) << (6 - depth))]
    assert covered == list(range(64))
    assert max(d for _, d in buckets) == 6 and min(d for _, d in buckets) == 3
    for prefix, depth in buckets:
        inside = sum(n for p, n in counts.items() if p >> (6 - depth) == prefix)
        assert inside <= 8 or depth == 6
    assert E.grow_directory({}, 0, 1) == [(0, 0)]


def test_owners_hold_key_ranges(spark):
    index = E.build_index(docs_frame(spark, ROWS), capacity=2)[0].collect()
    spans = {}
    for r in index:
        key = r["key"] % (1 << 64)
        low, high = spans.get(r["bucket"], (key, key))
        spans[r["bucket"]] = min(low, key), max(high, key)
    ordered = [spans[b] for b in sorted(spans)]
    assert len(ordered) > 2 and all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_stage_keeps_columns_and_one_row(spark):
    docs = docs_frame(spark, ROWS)
    kept = E.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [lower(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({lower(t) for _, t in ROWS})


def test_no_python_in_the_plan(spark):
    plan = E.exact_duplicates(docs_frame(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
