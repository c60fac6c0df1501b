"""Quality and toxicity: held-out accuracy on the given tables, and defined results for odd inputs."""

import numpy as np
import pytest

from helpers import docs_frame, remainder
from hazardry.llm import labelled, quality, toxicity

GIVEN = "/root/testdata/sf0.01"


def accuracy(spark, scores, target):
    labels = {r["doc_id"]: r[target] for r in spark.read.parquet(f"{GIVEN}/labels.parquet").collect()}
    rows = [r for r in scores.collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert len(rows) > 50
    for r in rows:
        assert remainder(r["doc_id"], 5) == 0 and 0 <= r["score"] <= 1
    return np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows])


def given(spark, name):
    return spark.read.parquet(f"{GIVEN}/{name}.parquet")


def test_quality_of_held_out_documents(spark):
    assert accuracy(spark, quality.quality_scores(given(spark, "documents"), given(spark, "labels")), "quality") > 0.95


def test_toxicity_of_held_out_documents(spark):
    assert accuracy(spark, toxicity.toxicity_scores(given(spark, "documents"), given(spark, "labels")), "toxic") > 0.93


@pytest.mark.parametrize("run,limit", [(quality.quality_scores, 0.3), (toxicity.toxicity_scores, 0.5)])
def test_odd_inputs(spark, run, limit):
    rows = [(k, f"plain words number {k} and more") for k in range(20)] + [(k, f"BAD!! ### idiot {k}") for k in range(20, 40)]
    rows += [(50, None), (51, ""), (None, "null id"), (7, "plain words number 7 and more"), (52, "ä" * 100_000), (53, " \n\n ")]
    docs = docs_frame(spark, rows)
    marks = [(k, int(k < 20), int(k >= 20)) for k in range(40)] + [(3, 0, 0), (None, 1, 1), (60, 1, 0), (50, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'z' as text")
    for table in (labels, labels.filter("quality = 1 and toxic = 0"), labels.filter("quality = 0 and toxic = 1"), labels.limit(0)):
        got = run(docs, table).collect()
        assert len(got) == len(rows)
        for r in got:
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= limit)
            assert r["held_out"] == (remainder(r["doc_id"], 5) == 0)
    assert run(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_read(spark):
    docs = given(spark, "documents")
    labels = given(spark, "labels")
    turned = labels.selectExpr("doc_id", *[f"if(crc32(cast(doc_id as string)) % 5 = 0, 1 - {c}, {c}) as {c}" for c in ("quality", "toxic")])
    for run in (quality.quality_scores, toxicity.toxicity_scores):
        a, b = (sorted((r["doc_id"], r["score"]) for r in run(docs, t).collect()) for t in (labels, turned))
        assert a == b


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    first, second = (sorted(map(tuple, labelled.training_sample(docs, labels, "toxic", 40).collect())) for _ in range(2))
    assert len(first) == 40 and first == second


def test_an_id_with_a_third_of_all_rows_gives_one_row(spark):
    rows = [(k, f"text {k}") for k in range(60)] + [(3, f"again {k % 20}") for k in range(30)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    sample = labelled.training_sample(docs_frame(spark, rows), labels, "toxic", 60).collect()
    ids = [k for k in range(60) if remainder(k, 5) != 0]
    assert 3 in ids and len(sample) == len(ids)
    assert {r["text"] for r in sample} >= {f"text {k}" for k in ids if k != 3}


def test_ranking_learns_the_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    worth = x @ np.array([2.0, -1.0, 0.0])
    good = (worth > np.quantile(worth, 0.2)).astype(int)
    ranking = quality.fit_ranking(x, good)
    assert np.corrcoef(ranking.raw(x), worth)[0, 1] > 0.99
    assert ((ranking.score(x) >= quality.THRESHOLD) == (good == 1)).mean() > 0.98


def test_folding():
    assert toxicity.folded("1D10T ѕcum ｔｒａｓｈ L0$er МОRОN cl​own") == ["idiot", "scum", "trash", "loser", "moron", "clown"]
    assert toxicity.folded("") == [] and toxicity.folded("---") == []


def test_lexicon_against_looking_at_every_word():
    weights = {" scum ": 2.0, " trash": 1.0, " trashy ": 3.0, " idio": 1.5}
    lexicon = toxicity.Lexicon(weights, {("trash", "can")})
    words = "scum scummy trash trashy can trash can idiot an idiom".split()
    want = []
    for k, w in enumerate(words):
        own = [v for e, v in weights.items() if (f" {w} " == e if e.endswith(" ") else f" {w}".startswith(e))]
        if own:
            want.append((max(own), words[k - 1] if k else "", w, words[k + 1] if k + 1 < len(words) else ""))
    assert sorted(lexicon.hits(words)) == sorted(want)
    heard = {w: x for x, before, w, after in want if (w, after) != ("trash", "can")}
    silenced = sum(heard.values()) / np.log2(16 + len(words))
    assert lexicon.density(words) == pytest.approx(silenced)
    assert toxicity.Lexicon().hits(words) == [] and toxicity.Lexicon(weights).hits([]) == []


def test_exceptions_are_learned(spark):
    docs = [(k, f"the {'idiot light' if k % 10 == 0 else 'idiot'} is on number {k}") for k in range(400)]
    docs += [(k, f"what a worthless idiot {k}") for k in range(400, 600)]
    marks = [(k, 1, int(k >= 400 or k % 10 > 0)) for k in range(600)] + [(k, 1, 0) for k in range(600, 5000)]
    docs += [(k, f"quite another text {k}") for k in range(600, 5000)]
    lexicon = toxicity.train(docs_frame(spark, docs), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert ("idiot", "light") in lexicon.exceptions
    assert lexicon.score("the 1d1ot is on number 4") > 0.5 > lexicon.score("the idiot light here")
