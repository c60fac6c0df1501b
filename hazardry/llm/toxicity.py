"""Toxicity from a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other scripts to Latin
ones, digits and signs inside words to the letters they stand for.  The lexicon
holds words and word beginnings with weights, found by an Aho-Corasick automaton
in one pass; of several entries in one word the heaviest counts.  A phrase of
two words that is listed as an exception silences its word.  The sum of weights
over distinct words is damped by the length of the text and turned into a
probability.

Entries, weights, exceptions and the last step are learned from labelled
documents.  An entry's weight is its log-odds between documents labelled toxic
and others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import text_or_empty
from hazardry.llm.labelled import SAMPLE_ROWS, held_out, training_sample

SHORTEST, LONGEST = 4, 8
LEAST_ODDS = 4.0
LEAST_DOCS = 5
LEAST_SHARE = 0.01
MOST_ENTRIES = 20_000
PHRASE_DOCS = 3

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x",
}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}


def _table() -> dict[int, str]:
    """Every character to its folded form; wide Latin letters too.  Other ASCII signs become blanks."""
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {c: chr(c).lower() for c in range(65, 91)}
    for k, latin in (HOMOGLYPHS | SUBSTITUTES).items():
        table[ord(k)] = latin
        if len(k.upper()) == 1:
            table[ord(k.upper())] = latin
    for k in range(26):
        for wide in (0xFF21, 0xFF41):
            table[wide + k] = chr(97 + k)
    table |= {c: "" for c in (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    return table


_FOLD = _table()


def folded(text: str) -> list[str]:
    """The words of a text after folding."""
    return text.lower().translate(_FOLD).split()


def entries_of(word: str) -> list[str]:
    """What may be learned from a word: its beginnings, each after a blank, and the whole between blanks."""
    return [f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + [f" {word} "]


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[tuple[str, str]] = field(default_factory=set)
    slope: float = 1.0
    base: float = 0.0

    def __post_init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            self.automaton.add_word(entry, (len(entry.rstrip(" ")), weight))
        self.automaton.make_automaton()

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.slope, self.base)

    def hits(self, words: list[str]) -> list[tuple[float, str, str, str]]:
        """(weight, word before, word, word after) of every word with an entry, heaviest entry each."""
        if not self.weights:
            return []
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        for end, (length, weight) in self.automaton.iter(line):
            start = end - (length if line[end] == " " else length - 1)
            if weight > best.get(start, 0.0):
                best[start] = weight
        found = []
        for start, weight in best.items():
            end = line.index(" ", start + 1)
            before = line[line.rfind(" ", 0, start) + 1 : start] if start else ""
            stop = line.find(" ", end + 1)
            found.append((weight, before, line[start + 1 : end], line[end + 1 : stop] if stop > 0 else ""))
        return found

    def density(self, words: list[str]) -> float:
        """Sum of weights of distinct words that no exception silences, damped by the text's length."""
        return damped(self.hits(words), self.exceptions, len(words))

    def score(self, text: str) -> float:
        z = self.slope * self.density(folded(text)) + self.base
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def damped(hits: list[tuple[float, str, str, str]], exceptions: set[tuple[str, str]], n_words: int) -> float:
    heard = {word: w for w, before, word, after in hits if not {(before, word), (word, after)} & exceptions}
    return sum(heard.values()) / np.log2(16 + n_words)


def _counted(sample: DataFrame, wanted: set[str] | None) -> DataFrame:
    """entry, label, n: documents of each label an entry occurs in; all entries, or the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {e for word in set(folded(text)) for e in entries_of(word)}
                counts.update((e, label) for e in (own if wanted is None else own & wanted))
            names = [k[0] for k in counts], [k[1] for k in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[0], pa.string()), pa.array(names[1], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["entry", "label", "n"],
            )

    return (
        sample.select("text", "label")
        .mapInArrow(run, "entry string, label int, n long")
        .groupBy("entry", "label")
        .agg(F.sum("n").alias("n"))
    )


def _hits(sample: DataFrame, lexicon: Lexicon) -> list[dict]:
    """Per sampled document: label, number of words and its hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(0).to_pylist():
                words = folded(text)
                sizes.append(len(words))
                found.append([dict(zip(("weight", "before", "word", "after"), h)) for h in lexicon.hits(words)])
            kind = pa.list_(pa.struct([("weight", pa.float64()), *((c, pa.string()) for c in ("before", "word", "after"))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, kind)], names=["label", "words", "hits"]
            )

    schema = "label int, words long, hits array<struct<weight: double, before: string, word: string, after: string>>"
    return sample.select("text", "label").mapInArrow(run, schema).toArrow().to_pylist()


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a one-feature logistic regression; a light ridge keeps separable data finite."""
    w = np.zeros(2)
    a = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        curve = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, a.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Lexicon:
    """A lexicon from at most `rows` labelled documents.

    Without a document labelled toxic it is empty and every score is the same,
    below one half; without any other, above.
    """
    sample = training_sample(docs, labels, "toxic", rows, distinct=True)  # copies would lend their words weight
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Lexicon(base=5.0 if n1 else -5.0)
    least = max(LEAST_DOCS, LEAST_SHARE * n1)
    toxic = (
        _counted(sample.filter("label = 1"), None)
        .filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "entry")
        .limit(MOST_ENTRIES)
        .collect()
    )
    df1 = {r["entry"]: r["n"] for r in toxic}
    df0 = {r["entry"]: r["n"] for r in _counted(sample.filter("label = 0"), set(df1)).collect()}
    odds = {e: np.log((n + 0.5) / (n1 + 1)) - np.log((df0.get(e, 0) + 0.5) / (n0 + 1)) for e, n in df1.items()}
    weights = {e: float(o) for e, o in odds.items() if o >= LEAST_ODDS}
    found = _hits(sample, Lexicon(weights))
    phrases: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for doc in found:
        phrases[doc["label"]].update({p for h in doc["hits"] for p in ((h["before"], h["word"]), (h["word"], h["after"]))})
    exceptions = {p for p, n in phrases[0].items() if all(p) and n >= PHRASE_DOCS and n > 4 * phrases[1][p] * n0 / n1}
    x = [damped([tuple(h.values()) for h in d["hits"]], exceptions, d["words"]) for d in found]
    slope, base = _logistic(np.array(x), np.array([d["label"] for d in found], float))
    return Lexicon(weights, exceptions, slope, base)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from one half on).

    Null texts are scored as empty ones.  Repeated rows are scored alike.
    """
    lexicon = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [lexicon.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    source = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    scored = source.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
