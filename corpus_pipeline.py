"""From raw documents to token ids: five stages, each written down and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardry.llm import decontaminate, exact_dedup, pieces, quality, simhash
from hazardry.llm.queries import MODEL
from hazardry.sources.workspace import staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking puts at its threshold or above."""
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints (three-word shingles, two bits) the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return pieces.encode(docs, MODEL)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", keep_one_copy),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", keep_uncontaminated),
    ("encoding", to_tokens),
]

#: The classifier, the hash of the fingerprints and the token ids are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
