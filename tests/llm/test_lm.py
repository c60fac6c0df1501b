from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

from helpers import docs_frame, lower, remainder
from hazardry.llm import lm as M


def tokens(text):
    return [*lower(text).encode().split(), b""]


def corpus():
    rng = np.random.default_rng(8)
    left, right = ([f"{c}{k}" for k in range(40)] for c in "lr")
    rows = []
    for k in range(160):
        words = left if k % 2 else right
        rows.append((k, " ".join(words[int(i)] for i in rng.integers(0, 40, rng.integers(5, 80)))))
    rows += [(k, f"rare{k} Été{k % 3} the\tTHE\nend") for k in range(200, 240)]
    return rows + [(300, None), (301, ""), (302, " \n"), (None, "null id"), (4, "again and again"), (4, "again and again"), (303, "the " * 50_000)]


@pytest.mark.parametrize("head", [1 << 18, 30, 1])
def test_counts_and_base_scores(spark, head):
    rows = corpus()
    counts = Counter(t for d, text in rows if remainder(d, 7) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    got = M.text_scores(docs_frame(spark, rows), head).collect()
    want = {}
    for d, text in rows:
        own = tokens(text)
        base = sum(log10((counts[t] + 1) / (n + v + 1)) for t in own)
        want[d, len(own)] = (remainder(d, 7) == 2, sum(counts[t] > 0 for t in own), n, base)
    assert len(got) == len(rows)
    for r in got:
        held, known, total, base = want[r["doc_id"], r["n_tokens"]]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held, known, total)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] < 0


def test_head_size_does_not_change_scores(spark):
    rows = corpus()
    a, b = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in M.text_scores(docs_frame(spark, rows), h).collect()} for h in (1 << 18, 200))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-5) for k in a)


def test_model_learns_context(spark):
    """Words of one half never follow words of the other; held-out texts are likelier than by the base line."""
    rows = [r for r in M.text_scores(docs_frame(spark, corpus())).collect() if r["held_out"] and (r["doc_id"] or 0) < 160]
    assert len(rows) > 10 and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 0.95


def test_fit_is_normalised_and_close_to_the_counts():
    rng = np.random.default_rng(3)
    size = 12
    truth = rng.dirichlet(np.ones(size) * 0.4, size)
    counts = np.zeros((size * M.GROUPS, size))
    for before in range(size):
        for group in range(M.GROUPS):
            counts[before * M.GROUPS + group] = rng.multinomial(2000, truth[before])
    table = M.fit(counts, steps=400)
    assert np.allclose((10**table).sum(axis=1), 1)
    seen = counts / counts.sum()
    model, unigram = (seen * table).sum(), (seen.sum(axis=0) * np.log10(seen.sum(axis=0))).sum()
    best = (seen * np.log10(np.maximum(counts / counts.sum(axis=1, keepdims=True), 1e-12))).sum()
    assert model > unigram + 0.8 * (best - unigram)


def test_whole_distribution_sums_to_one(spark):
    """Known words and one unseen word of each kind of ending share all the probability."""
    frame = docs_frame(spark, corpus()).selectExpr("cast(coalesce(text, '') as binary) as text")
    counts = M.count_tokens(frame).cache()
    words, _ = M.frequent_words(counts)
    n, distinct = M.class_totals(counts, words)
    inside = np.zeros(M.CLASSES)
    for row in counts.collect():
        token = bytes(row["token"])
        place = words.index.get(token, -1)
        k = place if 0 <= place < M.OWN else M.OWN + crc32(token[-3:]) % M.BY_ENDING
        inside[k] += 1.0 if k < M.OWN else (row["n"] + 1) / (n[k] + distinct[k] + 1)
    inside[M.OWN :] += 1 / (n + distinct + 1)[M.OWN :]
    assert np.allclose(inside, 1)


def test_contexts():
    got = M.contexts(np.array([5, 200, 3]))
    assert got.tolist() == [0, 5 * M.GROUPS, 200 * M.GROUPS + 5]


def test_no_training_documents(spark):
    only = [(d, t) for d, t in corpus() if remainder(d, 7) == 2]
    for rows in (only, []):
        got = M.text_scores(docs_frame(spark, rows)).collect()
        assert len(got) == len(rows) and all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
