"""Quality scores from pairwise preferences.

A document is described by a few densities of its characters, words and lines.
In the Bradley-Terry model the better of two documents wins with probability
logistic(s(better) - s(worse)), with s linear in the features; the weights
minimise the logistic loss on feature differences of pairs, one document
labelled good and one labelled bad.  The cut is the quantile of training scores
at the share of documents labelled bad, and scores are moved so that it falls
on THRESHOLD.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import free_names, text_or_empty
from hazardry.llm.labelled import SAMPLE_ROWS, held_out, training_sample

THRESHOLD = 0.3
PAIRS = 200_000
RIDGE = 1e-3
SEED = 7

_LETTERS = bytes(c for c in range(256) if c >= 128 or 65 <= c <= 90 or 97 <= c <= 122)
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_STOPS = b".,;:'\"()-?"
_SYMBOLS = bytes(c for c in range(33, 127) if c not in _LETTERS + _DIGITS + _STOPS)
FEATURES = 11


def _share(text: bytes, letters: bytes, n: int) -> float:
    return (len(text) - len(text.translate(None, letters))) / n


def features(text: bytes) -> np.ndarray:
    """Log-damped densities, all zero but the lengths for an empty text."""
    n = max(len(text), 1)
    words = text.split()
    many = max(len(words), 1)
    lines = [line for line in text.split(b"\n") if line]
    repeats = sum(map(eq, words, words[1:])) / many
    distinct = len(set(words)) / many
    shares = [
        _share(text, _SYMBOLS, n),
        _share(text, _CAPITALS, n),
        _share(text, _DIGITS, n),
        text.count(b"|") / many,
        text.count(b"!") / many,
        repeats,
        (1 - distinct) / np.log(many + 1),
        1 - len(set(lines)) / max(len(lines), 1),
        _share(text, _STOPS, n),
    ]
    return np.array([*(np.log1p(50 * s) for s in shares), np.log1p(many) / 10, min(n / many, 50) / 10])


@dataclass(frozen=True)
class Ranking:
    """Weights and the cut; `score` is 0 to 1 and THRESHOLD at the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS) -> Ranking:
    """Newton steps on the pairwise logistic loss.

    Pairs are drawn with a fixed seed.  With one label only there is nothing to
    rank: weights are zero, and every score is THRESHOLD or more if that label
    is 1 or there is none, and less if it is 0.
    """
    winners, losers = np.nonzero(good == 1)[0], np.nonzero(good == 0)[0]
    dims = x.shape[1]
    if not len(winners) or not len(losers):
        return Ranking(np.zeros(dims), np.ones(dims), np.zeros(dims), 1.0 if len(losers) else 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / scale
    draw = np.random.default_rng(SEED)
    d = z[draw.choice(winners, pairs)] - z[draw.choice(losers, pairs)]
    w = np.zeros(dims)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        gradient = d.T @ p / pairs - RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(dims)
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    cut = np.quantile(z @ w, len(losers) / len(x), method="midpoint")
    return Ranking(mean, scale, w, float(cut))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ranking:
    """A ranking from at most `rows` labelled documents; their features, not their texts, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "label"])

    sample = training_sample(docs, labels, "quality", rows)
    found = sample.select(F.col("text").cast("binary"), "label").mapInArrow(run, "x array<double>, label int").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, FEATURES)
    good = found.column("label").to_numpy()
    order = np.lexsort([*x.T, good])  # the fit doesn't depend on the order in which rows arrive
    return fit_ranking(x[order], good[order])


def score_column(docs: DataFrame, ranking: Ranking, name: str) -> DataFrame:
    """All rows and columns of docs with the score; null texts are scored as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            x = np.array([features(t.as_py()) for t in batch.column(last)]).reshape(-1, FEATURES)
            own = [batch.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(ranking.score(x))], names=schema.names)

    schema = docs.withColumn(name, F.lit(0.0).cast("double")).schema
    return docs.select("*", text_or_empty().cast("binary").alias(*free_names(docs, "__bytes"))).mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from THRESHOLD on)."""
    scored = score_column(docs.select("doc_id", "text"), train(docs, labels), "score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score THRESHOLD or more, with all their columns."""
    (score,) = free_names(docs, "__quality")
    return score_column(docs, train(docs, labels), score).filter(F.col(score) >= THRESHOLD).select(*docs.columns)
