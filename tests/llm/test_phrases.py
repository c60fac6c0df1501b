import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardry.llm import phrases
from helpers import docs_frame, lower


def brute(rows, most=3, least=10, top=2000):
    langs = {}
    for text, lang in rows:
        langs.setdefault("und" if lang is None else lang, []).append(lower(text))
    out = []
    for lang, texts in langs.items():
        f, n = Counter(), 0
        for t in texts:
            for piece in re.split("[.,;:!?\n-\r]", t):
                w = re.findall("[^ \t]+", piece)
                n += len(w)
                for m in range(1, most + 1):
                    f.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in chosen.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(a, inside.get(p[i : i + m], 0))
        ranked = []
        for p, a in chosen.items():
            if 100 * inside.get(p, 0) >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "A", "ab", "b", "New", "york", "new\x0byork", "ß", "漢字", "x" * 300, "c.d", "e-f", "\x00", "g h"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", "\n", " \t "]
    make = lambda: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(0, 40)))
    rows = [(make(), rng.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [(None, "en"), ("", "fr"), (" \t\n.", "fr"), ("one two three four", "es")] + [("one two three four", "en")] * 15


@pytest.mark.parametrize("most, least, buckets, shard, at_once", [(3, 10, 1 << 21, 200_000, 4), (4, 3, 60, 25, 2), (2, 5, 1 << 21, 7, 1)])
def test_against_brute_force(spark, most, least, buckets, shard, at_once):
    """Also with many blocks of buckets, and shards of tries that take several passes and hold two languages."""
    rows = rows_of(most)
    frame = docs_frame(spark, [(i, t, x, "s", 1) for i, (t, x) in enumerate(rows)]).selectExpr("*", "1 as phrase", "2 as bucket", "3 as n", "4 as shard")
    got = phrases.collocations(frame, most, least, 2000, buckets, shard, at_once).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, most, least)


def test_phrases_that_share_a_bucket(spark, monkeypatch):
    """A phrase its bucket's text does not spell leaves the bucket's count unexplained, and is spelled by all texts."""
    rows = rows_of(5)
    frame = docs_frame(spark, [(i, t, x, "s", 1) for i, (t, x) in enumerate(rows)])
    texts = frame.selectExpr("coalesce(lang, 'und') as lang", "cast(coalesce(text, '') as binary) as text")
    full, found = phrases.full_buckets(texts)
    counts = phrases.phrase_counts(texts, phrases._with_words(found)).cache()
    assert phrases.shared_buckets(full, found, counts).count() == 0
    few = found.orderBy("lang", "phrase").limit(found.count() - 3)
    fewer = phrases.phrase_counts(texts, phrases._with_words(few))
    assert phrases.shared_buckets(full, few, fewer).count() == 3
    spelled = phrases.spelled
    lose = lambda texts, words, block, anywhere=False, held=9: spelled(texts, words, block, anywhere, held).filter(F.lit(anywhere) | (F.col("bucket") % 3 != 0))
    monkeypatch.setattr(phrases, "spelled", lose)
    assert sorted(tuple(r) for r in phrases.collocations(frame).collect()) == brute(rows)


def test_top_per_language(spark):
    rows = rows_of(9)
    frame = docs_frame(spark, [(i, t, x, "s", 1) for i, (t, x) in enumerate(rows)])
    assert sorted(tuple(r) for r in phrases.collocations(frame, top=3).collect()) == brute(rows, top=3)


def test_trie_and_hashes():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["ab", "abc", "b", "éa", "z" * 50], k=200)) + ("." if i % 2 else "\n") for i in range(20)]
    pieces = phrases.Pieces([t.encode() for t in texts])
    words = [bytes(pieces.data[s:e]) for s, e in zip(pieces.starts, pieces.ends)]
    assert words == [w.encode() for t in texts for w in re.findall(r"[^ .\n]+", t)]
    whole = pieces.word_hashes()
    by_word = {}
    for w, h in zip(words, whole.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    phrases_, chunk = sorted({b"ab", b"abc", b"ab abc", b"b", b"b b b", b"\xc3\xa9a ab", b"nowhere"}), phrases.CHUNK
    counts = phrases.Trie(phrases_).count(pieces)
    lines = [re.findall(r"[^ .\n]+", t) for t in texts]
    for p, n in zip(phrases_, counts.tolist()):
        w = p.decode().split()
        assert n == sum(line[i : i + len(w)] == w for line in lines for i in range(len(line)))
    try:
        phrases.CHUNK = 70
        assert np.array_equal(pieces.word_hashes(), whole)
    finally:
        phrases.CHUNK = chunk


def test_very_long_text_and_empty_table(spark):
    text = "alpha beta gamma. " * 60_000
    frame = docs_frame(spark, [(1, text, "en", "s", 1), (2, "word" * 100_000, "en", "s", 1)])
    assert [tuple(r) for r in phrases.collocations(frame).collect()] == brute([(text, "en"), ("word" * 100_000, "en")])
    assert phrases.collocations(docs_frame(spark, [])).count() == 0


def test_passes_over_the_texts_do_not_grow_with_candidates(spark, monkeypatch):
    """Many small blocks and shards read the texts as often as one of each: for words, buckets of each length, spelling and counting."""
    rows, passes, over = rows_of(11), [], type(spark.range(0)).mapInArrow

    def counted(self, func, *args, **named):
        passes.append(self.columns == ["lang", "text"])
        return over(self, func, *args, **named)

    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", counted)
    monkeypatch.setattr(phrases, "SLICES", 3)
    frame = docs_frame(spark, [(i, t, x, "s", 1) for i, (t, x) in enumerate(rows)])
    for buckets, shard, at_once in [(1 << 21, 200_000, 4), (200, 20, 1)]:
        passes.clear()
        got = phrases.collocations(frame, 3, 10, 5, buckets, shard, at_once).collect()
        assert sorted(tuple(r) for r in got) == brute(rows, 3, 10, 5)
        assert sum(passes) == 5


def test_equal_runs_are_told_by_bytes():
    """Runs that share a hash are one only if all bytes agree, whatever their length."""
    rng = random.Random(2)
    words = ["a", "b", "abcdefgh", "abcdefgi", "abcdefghabcdefgh", "abcdefghabcdefgi", "xbcdefghabcdefghz", "abcdefg"]
    text = " ".join(rng.choices(words, k=3000))
    pieces, line = phrases.Pieces([text.encode()]), text.split()
    for m in (1, 2):
        first = np.arange(len(line) - m + 1)
        own = np.array([rng.randrange(3) << 40 for _ in first], np.uint64)
        at, hashes, counts = pieces.distinct(first, m, own, True)
        assert (np.diff(hashes.view(np.int64)) >= 0).all()
        found = Counter()
        for data, n in zip(pieces.lines(at, m)[0].tobytes().split(b"\n"), counts.tolist()):
            found[data.decode()] += n
        assert found == Counter(" ".join(line[i : i + m]) for i in first)
        trie = phrases.Trie(sorted(k.encode() for k in found))
        assert trie.count_lines(pieces.lines(at, m)[0], counts).tolist() == [found[k] for k in sorted(found)]
