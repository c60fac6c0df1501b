import re
from hashlib import sha256

import numpy as np
import pytest

from helpers import by_id, docs_frame, lower
from hazardry.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower(text))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            size = min(len(w), 10)
            windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(own), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=lambda r: (r[0] is None, r[0], str(r[1:])))


def passage(rng, n, vocabulary=60):
    return " ".join(f"w{rng.integers(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(5)
    items = [(k, passage(rng, int(rng.integers(10, 60)))) for k in range(30)]
    items += [(40, "one"), (41, "two short words"), (42, ""), (43, None), (None, passage(rng, 12)), (9, passage(rng, 20)), (44, "la " * 30), (45, passage(rng, 9))]
    docs = [(k, passage(rng, int(rng.integers(0, 120)))) for k in range(40)]
    for k in range(40):
        item = items[int(rng.integers(30))][1].split()
        cut = int(rng.integers(0, max(len(item) - 10, 1)))
        span = item[cut : cut + int(rng.integers(8, 14))]
        docs.append((100 + k, f"{passage(rng, 15)}, {'! '.join(span).upper()}? {passage(rng, 15)}"))
    docs += [(200, None), (201, ""), (202, "One"), (None, items[0][1]), (203, "La-la_" * 40), (204, "two SHORT\twords again"), (204, "two SHORT\twords again")]
    docs.append((205, (passage(rng, 3000) + " " + items[3][1] + " ") * 8))
    docs.append((206, items[37][1] + " ünï " + items[36][1]))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 150])
def test_against_brute_force(spark, case, block_bytes):
    docs, items = case
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(docs_frame(spark, docs), frame, block_bytes)
    assert by_id(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute(docs, items)


def test_empty_tables(spark, case):
    docs, items = case
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination(docs_frame(spark, []), frame).count() == 0
    none = D.contamination(docs_frame(spark, docs), frame.limit(0)).collect()
    assert len(none) == len(docs) and not any(r["contaminated"] for r in none)


def test_winnowing_guarantee():
    """Two texts that share ten words have a fingerprint in common, at the same words."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        shared = rng.integers(0, 4, 10)
        a, b = (np.concatenate([rng.integers(0, 4, rng.integers(0, 30)), shared, rng.integers(0, 4, rng.integers(0, 30))]) for _ in range(2))
        prints = [set(h[D.winnow(h, 6)].tolist()) for h in (D.gram_hashes(x, 5) for x in (a, b))]
        assert prints[0] & prints[1]
    h = np.array([5, 3, 3, 9, 1, 7, 7, 7, 7], np.uint64)
    assert D.winnow(h, 3).tolist() == [2, 4, 7, 8]


def test_stage_keeps_clean_documents(spark, case):
    docs, items = case
    frame = docs_frame(spark, docs)
    kept = D.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    clean = [r[0] for r in brute(docs, items) if not r[5]]
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == clean
