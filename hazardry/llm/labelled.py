"""Bounded samples of labelled documents for fitting, and held-out folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import fold, text_or_empty
from hazardry.sources.workspace import staged

FOLDS = 5
SAMPLE_ROWS = 40_000


def held_out() -> Column:
    return fold("doc_id", FOLDS) == 0


def training_sample(
    docs: DataFrame, labels: DataFrame, target: str, rows: int = SAMPLE_ROWS, distinct: bool = False
) -> DataFrame:
    """text and label (0 or 1) of labelled documents outside the held-out fold, written down.

    At most `rows` labels, those with the smallest hash of their id, whatever
    the size of the corpus; they are broadcast, so documents are not shuffled.
    An id with several labels counts once, with the largest; an id with several
    texts counts once, with the text of the smallest hash.  Null ids and null
    labels are passed over.  With `distinct`, equal texts with equal labels count once.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col(target).cast("int")).alias("label"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("hash", F.xxhash64("text"))
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("hash").alias("hash"))
    picked = staged(one, f"picked-{target}")  # `rows` at most, so it may be broadcast
    sample = texts.join(F.broadcast(picked), ["doc_id", "hash"]).select("doc_id", "text", "label").distinct()
    sample = sample.select("text", "label")
    return staged(sample.distinct() if distinct else sample, f"sample-{target}")
