import random
import re
from collections import Counter

import numpy as np
import pytest

from hazardry.llm import divergence
from helpers import docs_frame, lower

TERM = re.compile("[a-z\x80-\U0010ffff]+")


def brute(rows, least, top=50):
    docs = [(x or "", s or "", Counter(TERM.findall(lower(t)))) for t, x, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = [t for t, n in df.items() if n >= least]
        sums = {}
        for _, source, c in own:
            sums.setdefault(source, Counter()).update(c)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in sums.items()}
        q = shares(sum(sums.values(), Counter()))
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if sums[s][t] and p[s][t] > q[t]]
            for part, items, n in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:n]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items)]
    return sorted(out)


def rows_of(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "ab", "abc", "abcd", "abcde", "Straße", "ß", "étude", "zz" * 40, "zz" * 40 + "y", "the", "x1y", "İ", "漢字"] + ["w" + chr(97 + i) * 5 for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", None, ""])) for _ in range(n)]
    rows += [(None, "en", "only nulls"), ("", "fr", "a"), ("", "fr", "b"), ("rare words", "es", "c")]
    return rows + [("THE the The", "en", "s1")] * 12


@pytest.mark.parametrize("least, most_broadcast, cells, held", [(3, 10**6, 1 << 18, 10**6), (9, 0, 8, 7)])
def test_against_brute_force(spark, monkeypatch, least, most_broadcast, cells, held):
    """Few and many: broadcast and joined prefixes, one and many chunks, notes let go early."""
    notes = divergence.term_notes
    monkeypatch.setattr(divergence, "term_notes", lambda docs: notes(docs, held))
    monkeypatch.setattr(divergence, "NOTES_AT_ONCE", held)
    rows = rows_of(least)
    frame = docs_frame(spark, [(i, t, x, s, 1) for i, (t, x, s) in enumerate(rows)])
    frame = frame.selectExpr("*", "1 as term", "2 as g", "3 as n", "'q' as head")
    got = divergence.source_divergence(frame, least, 50, most_broadcast, cells).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, least)


def test_top_and_hot_source(spark):
    rows = [(" ".join(f"t{chr(97 + i)}{chr(97 + j)}" for j in range(i + 1)), "en", "hot" if i % 3 else "cold") for i in range(26)] * 3
    frame = docs_frame(spark, [(i, t, x, s, 1) for i, (t, x, s) in enumerate(rows)])
    got = divergence.source_divergence(frame, 2, 4).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 4)


def test_discarded_prefixes_are_not_read_again(spark):
    """Below a prefix that is discarded no longer one is counted, and a shared prefix counts once a document."""
    frame = docs_frame(spark, [(i, "qaaa qbbb qaaa" if i < 2 else f"abcd{chr(97 + i)}", "en", "s", 1) for i in range(9)])
    notes = divergence.term_notes(frame).cache()
    assert divergence.kept_terms(notes, 2).count() == 2 and divergence.kept_terms(notes, 3).count() == 0
    terms = [b"ab", b"abc", b"abcd", b"abcde", b"abcdefgh", b"abcdefgi", b"b" * 40, b"b" * 40 + b"c", b"b" * 64, b"b" * 64 + b"c"]
    new = np.array([False] * len(terms))
    new[0] = True
    assert divergence.shared_levels(terms, new).tolist() == [0, 0, 0, 1, 1, 1, 0, 4, 4, 5]


def test_empty(spark):
    assert divergence.source_divergence(docs_frame(spark, [])).count() == 0


def test_few_files_of_many_partitions(spark, monkeypatch):
    """Tables between steps are written by a few tasks a core, also when the session shuffles into many partitions."""
    monkeypatch.setattr(divergence, "TASKS_PER_CORE", 1)
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(4 * cores)
    table = divergence._gathered(many, "test-gathered", 1000)
    assert len(table.inputFiles()) <= cores and table.count() == 1000
    monkeypatch.setattr(divergence, "ROWS_PER_TASK", 1000 // (3 * cores))
    assert len(divergence._gathered(many, "test-gathered", 1000).inputFiles()) >= 3 * cores
