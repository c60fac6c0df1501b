import heapq
import math

import numpy as np
import pytest

from hazardry.llm import multi_index

SHAPE = "vec_id long, embedding array<float>, label int"


def frame_of(spark, rows, partitions=3):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SHAPE)
    return frame.repartition(partitions).selectExpr("*", "1 as id", "2 as vector", "3 as key1", "4 as shard", "5 as cell")


def brute(rows, k=20, step=20):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        kept[i] = min(v, kept.get(i, v))
    out = {}
    for q, v in kept.items():
        if q % step == 0:
            near = heapq.nsmallest(k, ((-math.fsum(a * b for a, b in zip(v, w)), i) for i, w in kept.items() if i != q))
            out[q] = [(i, -s) for s, i in near]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def close(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12, atol=1e-12)


def clustered(n, dims, seed=0, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dims))


def test_whole_small_table_with_odd_rows(spark):
    """Few vectors are searched whole, so the answer is exact: nulls, zeros, repeats, ties, other lengths."""
    rows = [(i, v) for i, v in enumerate(np.round(clustered(60, 5), 1).tolist())]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0, 2.0]) for i in range(40)]  # a vector with two thirds of the rows
    rows += [(200, None), (201, [0.0] * 5), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] * 5)]
    rows += [(220, [-0.0, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 5), (20, rows[20][1]), (40, [-9.0] * 5), (0, [9.0] * 5)]
    want = brute(rows)
    close(found(multi_index.nearest(frame_of(spark, [*rows, (205, [1.0] * 6)]))), want)
    assert all(len(x) == 20 for x in want.values())


def test_fewer_candidates_than_asked_for(spark):
    rows = [(i, [1.0, float(i)]) for i in range(0, 25, 5)]
    close(found(multi_index.nearest(frame_of(spark, rows))), brute(rows))
    assert multi_index.nearest(frame_of(spark, [(0, [1.0])])).count() == 0
    assert multi_index.nearest(frame_of(spark, [])).count() == 0


@pytest.mark.parametrize("block", [None, 50])
def test_recall(spark, block):
    """Clustered and plain vectors against brute force; small blocks cut cells over shards."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([clustered(1500, 8), rng.normal(size=(500, 8)), np.tile(rng.normal(size=8), (900, 1))])
    rows = list(enumerate(vectors.tolist()))
    got, want = found(multi_index.nearest(frame_of(spark, rows), centroids=16, block=block)), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    table = dict(rows)
    for q, near in got.items():
        for i, s in near:
            assert math.isclose(s, float(np.float32(table[q]).astype(float) @ np.float32(table[i]).astype(float)), rel_tol=1e-12, abs_tol=1e-12)


def test_traversal_and_layout():
    rng = np.random.default_rng(1)
    quantiser = multi_index.Quantiser(rng.normal(size=(300, 7)), 9)
    query = rng.normal(size=7)
    path = list(quantiser.traverse(query))
    total = lambda c: quantiser.halves[0][c // 9] @ query[:4] + quantiser.halves[1][c % 9] @ query[4:]
    assert sorted(path) == list(range(81)) and all(total(a) >= total(b) - 1e-12 for a, b in zip(path, path[1:]))
    first, parts, shards = multi_index.layout(np.array([3, 0, 25, 4, 4, 4]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1] and shards == 6
