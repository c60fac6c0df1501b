"""Log-bilinear language model over all training documents, and scores of texts.

Tokens are words between ASCII blanks, A-Z in lower case, and one end per text.
Counts of all training tokens give the unigram base line.  For the neural model
tokens fall into CLASSES classes: the most frequent words have one each, other
words are put together by their last bytes.  Then

    P(word | context) = P(class | context) * P(word | class),

the second factor an add-one unigram inside the class with one share for unseen
words, the first a log-bilinear model: the class before and the group of the
class before that predict a vector, and its product with a class's vector, plus
a bias, is that class's logit.  Parameters are trained in numpy by
noise-contrastive estimation, with unigram noise, on the counts of all
(group, class, class) triples of the training documents.  These are gathered by
Spark; there are GROUPS * CLASSES**2 of them however large the corpus is.  One
batched matrix product then gives the normalised log-probabilities of every
class in every context.

Scoring reads each text once.  The HEAD most frequent words travel to the tasks
with their counts; other words are joined to theirs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import fold, text_or_empty
from hazardry.sources.workspace import staged

FOLDS, HELD_FOLD = 7, 2
END = b""
OWN = 128
BY_ENDING = 128
CLASSES = OWN + BY_ENDING
GROUPS = 16
DIMS = 24
NOISE = 10
STEPS = 150
HEAD = 1 << 18
COUNTER_SIZE = 400_000
ENDING = 3


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def ending_class(word: bytes) -> int:
    return OWN + crc32(word[-ENDING:]) % BY_ENDING


def count_tokens(train: DataFrame) -> DataFrame:
    """token, n over all rows of `text` (binary), added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["token", "n"]
            )

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens(text.as_py()))
                if len(counts) > COUNTER_SIZE:
                    yield out()
                    counts = Counter()
        yield out()

    return train.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """Counts the tasks need: frequent tokens, the end first, then by falling count; and totals."""

    index: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    distinct: int

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Place of each word among the frequent ones or -1, its class, and the words that are not among them."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        classes = self.classes[at]
        rare = np.nonzero(at < 0)[0]
        others = [words[i] for i in rare.tolist()]
        classes[rare] = [ending_class(w) for w in others]
        return at, classes, others


def level_of(n: str):
    """Eighths of a power of two, so that a table of any size has a few hundred levels."""
    return F.floor(F.log2(n) * 8)


def frequent_words(counts: DataFrame, head: int = HEAD) -> tuple[Words, int]:
    """The words above the lowest level that keeps them to `head`, and that level.

    `counts` is the stored table of all training tokens.
    """
    levels = counts.groupBy(level_of("n").alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    cut, room = 1 << 20, head
    for row in sorted(levels, key=lambda r: -r["level"]):
        room -= row["words"]
        if room < 0:
            break
        cut = row["level"]
    rows = counts.filter((level_of("n") >= cut) | (F.col("token") == F.lit(END))).collect()
    found = {bytes(r["token"]): r["n"] for r in rows}
    order = sorted(found.keys() - {END}, key=lambda t: (-found[t], t))
    index = {t: i for i, t in enumerate([END, *order])}
    classes = np.array([*range(min(OWN, len(index))), *(ending_class(t) for t in order[OWN - 1 :]), 0], np.int64)
    return Words(
        index,
        np.array([found.get(END, 0), *(found[t] for t in order)], np.int64),
        classes,
        sum(r["n"] for r in levels),
        sum(r["words"] for r in levels),
    ), cut


def class_totals(counts: DataFrame, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class."""
    own = [t for t, i in words.index.items() if i < OWN]
    ending = F.crc32(F.substring("token", -ENDING, ENDING)) % BY_ENDING + OWN
    rows = (
        counts.filter(~F.col("token").isin([F.lit(t) for t in own]))
        .groupBy(ending.alias("class"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
        .collect()
    )
    n, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    n[: min(OWN, len(words.counts))] = words.counts[:OWN]
    for r in rows:
        n[r["class"]], distinct[r["class"]] = r["n"], r["words"]
    return n, distinct


def contexts(classes: np.ndarray) -> np.ndarray:
    """Number of each token's context; what stands before a text counts as an end, class 0."""
    before = np.concatenate([[0, 0], classes])
    return before[1:-1] * GROUPS + before[:-2] % GROUPS


def count_triples(train: DataFrame, words) -> np.ndarray:
    """Counts of (context, class) over all training documents; `words` is broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES * GROUPS * CLASSES, np.int64)
        for batch in batches:
            for text in batch.column(0):
                _, classes, _ = words.value.look_up(tokens(text.as_py()))
                np.add.at(counts, contexts(classes) * CLASSES + classes, 1)
        cells = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])

    rows = train.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES * GROUPS * CLASSES)
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return counts.reshape(CLASSES * GROUPS, CLASSES)


def fit(counts: np.ndarray, steps: int = STEPS, seed: int = 3) -> np.ndarray:
    """log10 P(class | context), contexts by classes, from counts of the same shape.

    Noise-contrastive estimation tells each seen class from NOISE draws of the
    unigram noise; with so few classes the expectation over the noise is taken
    exactly.  Adam on the whole table at once.
    """
    draw = np.random.default_rng(seed)
    total = max(counts.sum(), 1.0)
    noise = (counts.sum(axis=0) + 1) / (counts.sum() + counts.shape[1])
    share, seen = (counts / total).astype(np.float32), (counts.sum(axis=1, keepdims=True) / total).astype(np.float32)
    before, group = np.divmod(np.arange(len(counts)), GROUPS)
    size = counts.shape[1]
    p = {
        "before": draw.normal(0, 0.1, (size, DIMS)),
        "mix": np.eye(DIMS),
        "group": draw.normal(0, 0.1, (GROUPS, DIMS)),
        "target": draw.normal(0, 0.1, (size, DIMS)),
        "bias": np.log(noise),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    offset = np.log(NOISE * noise).astype(np.float32)
    against = (NOISE * noise).astype(np.float32)

    def predicted() -> np.ndarray:
        return (p["before"] @ p["mix"])[before] + p["group"][group]

    for step in range(1, steps + 1):
        hat = predicted()
        real = 1 / (1 + np.exp(-np.clip(hat @ p["target"].T + p["bias"] - offset, -30, 30)))
        pull = share * (1 - real) - seen * against * real
        back = pull @ p["target"]
        by_class = back.reshape(size, GROUPS, DIMS).sum(axis=1)
        gradient = {
            "target": pull.T @ hat,
            "bias": pull.sum(axis=0),
            "group": back.reshape(size, GROUPS, DIMS).sum(axis=0),
            "mix": p["before"].T @ by_class,
            "before": by_class @ p["mix"].T,
        }
        for k, g in gradient.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] = p[k] + 0.05 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-10)
    logits = (predicted() @ p["target"].T + p["bias"]).astype(np.float64)
    logits -= logits.max(axis=1, keepdims=True)
    return (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))) / np.log(10)


def text_scores(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the whole text with its end.  Null and
    empty texts are their end alone.  Documents of the held-out fold are scored
    but not learned from.  With no training document every base score is 0.
    Repeated rows are learned and scored each.
    """
    sc = docs.sparkSession.sparkContext
    held_out = fold("doc_id", FOLDS) == HELD_FOLD
    source = docs.select("doc_id", held_out.alias("held_out"), text_or_empty().cast("binary").alias("text"))
    train = source.filter(~F.col("held_out"))
    counts = staged(count_tokens(train), "lm-counts")
    words, cut = frequent_words(counts, head)
    n, distinct = class_totals(counts, words)
    sent = sc.broadcast(words)
    table = sc.broadcast(fit(count_triples(train, sent)).astype(np.float32))
    # log10 of what the unigram inside a class divides by; a class of one word divides by nothing
    shares = np.where(np.arange(CLASSES) < OWN, 0.0, np.log10(n + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(sent.value.counts + 1.0)
        inside = np.where(np.arange(len(logs)) < OWN, 0.0, logs)
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for text in batch.column(2):
                own = tokens(text.as_py())
                at, classes, others = sent.value.look_up(own)
                known = at[at >= 0]
                by_class = table.value[contexts(classes), classes].sum(dtype=np.float64)
                row = (
                    len(own),
                    len(known) - int(not sent.value.counts[0]),
                    logs[known].sum(),
                    by_class + inside[known].sum() - shares[classes].sum(),
                    others,
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "held_out", "n_tokens", "known", "logs", "model", "others"],
            )

    schema = (
        f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, known long, logs double, model double, others array<binary>"
    )
    read = staged(source.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = counts.filter(level_of("n") < cut)
    joined = (
        read.select("row", F.explode("others").alias("token"))
        .join(rare, "token", "left")
        .groupBy("row")
        .agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more_logs"), F.count("n").alias("more_known"))
    )
    more = F.coalesce("more_logs", F.lit(0.0))
    everything = np.log10(words.tokens + words.distinct + 1)
    return read.drop("others").join(joined, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(float(everything))).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
