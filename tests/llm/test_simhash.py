from collections import defaultdict

import numpy as np
import pytest
import xxhash

from helpers import by_id, docs_frame, lower
from hazardry.llm import simhash as S
from hazardry.llm.components import components


def brute_print(text):
    words = lower(text).encode().split()
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows, radius=2):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] += [doc_id] if doc_id is not None else []
    out = [(d, f"{prints[i]:016x}", min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=lambda r: (r[0] is None, r[0], str(r[1:])))


def corpus():
    rng = np.random.default_rng(11)
    base = [[f"w{rng.integers(400)}" for _ in range(rng.integers(60, 160))] for _ in range(12)]
    rows = []
    for k, words in enumerate(base):
        for copy in range(12):
            own = list(words)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(len(own)))] = f"v{rng.integers(400)}"
            rows.append((1000 - 13 * k - copy, " ".join(own)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "a b c " * 30_000)]
    rows += [(None, rows[0][1]), (5, rows[0][1].upper()), (5, rows[0][1].upper()), (7, "Ünï côdé wörds joined")]
    return rows


def test_fingerprints(spark):
    rows = corpus()
    got = {(r["doc_id"], r["fp"] % (1 << 64)) for r in S.fingerprints(docs_frame(spark, rows)).collect()}
    assert got == {(d, brute_print(t)) for d, t in rows}


@pytest.mark.parametrize("block", [1 << 15, 3])
def test_components_against_all_pairs(spark, block):
    rows = corpus()
    got = S.near_duplicates(docs_frame(spark, rows), block=block)
    assert by_id(got, "fingerprint", "component_id") == brute(rows)


def test_empty_table(spark):
    assert S.near_duplicates(docs_frame(spark, [])).collect() == []


def close_prints(rng, n, centres):
    centre = rng.integers(0, 1 << 63, centres, dtype=np.int64).view(np.uint64)
    prints = centre[rng.integers(0, centres, n)]
    for _ in range(4):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(prints)


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_tree_search_finds_every_link(radius):
    rng = np.random.default_rng(radius)
    prints = close_prints(rng, 700, 9)
    rng.shuffle(prints)
    shard = rng.integers(0, 5, len(prints))
    found = set()
    for q, m in S.Forest(prints, shard).search(prints, shard, radius):
        found |= set(zip(q.tolist(), m.tolist()))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(near & (shard[:, None] == shard[None, :])))))


def test_tree_prunes():
    """A search looks at a small part of a tree of unrelated prints."""
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 4000, dtype=np.int64).view(np.uint64)
    forest = S.Forest(prints, np.zeros(len(prints), np.int64))
    looked, count = 0, np.bitwise_count

    def counted(x):
        nonlocal looked
        looked += x.size
        return count(x)

    S.np.bitwise_count = counted
    try:
        list(forest.search(prints[:200], np.zeros(200, np.int64), 2))
    finally:
        S.np.bitwise_count = count
    assert looked < 0.2 * 200 * 4000


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(200, 260)] + [(7, 7), (300, 2), (2, 300), (2, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    want = {k: 100 for k in range(100, 141)} | {k: 1 for k in [1, *range(200, 260)]} | {k: 2 for k in (2, 300, 301)}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_stage_keeps_one_of_each(spark):
    rows = [(d, t) for d, t in corpus() if d is not None]
    kept = S.drop_near_duplicates(docs_frame(spark, rows))
    assert {r["doc_id"] for r in kept.collect()} == {r[2] for r in brute(rows)}
