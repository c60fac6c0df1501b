"""Documents by key in plain Parquet, upserted by rewriting the hash folders a batch touches.

A batch changes documents field by field: a document takes every field, NULL or
not, that the batch has, and keeps the others.  Only the folders its keys fall
into are read, merged with the batch in one join and overwritten; the rest of the
store is not touched.  Writing a batch again changes nothing, so a retry does no
harm.  One writer at a time: streams that share a store are united into one query
or run one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardry.operators.ranking import keep_one
from hazardry.sources.readers import existing, file_system

BUCKETS = 32


def upsert(current: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``current`` (one row per key) after a batch: matched rows are updated, new ones inserted.

    Within the batch the last row of a key in ``order`` wins; rows without a key
    are left out (see :func:`upsert_report`).  The batch is the hashed side of
    the join, so the store is neither sorted nor aggregated.
    """
    latest = keep_one(batch.filter(F.col(key).isNotNull()), key, order, keep="last")
    new = latest.select([F.col(c).alias(f"_new_{c}") for c in latest.columns]).withColumn("_changed", F.lit(True))
    joined = current.join(new.hint("shuffle_hash"), F.col(key) == F.col(f"_new_{key}"), "full_outer")

    def value(c: str) -> Column:
        if c not in current.columns:
            return F.col(f"_new_{c}").alias(c)
        return (F.when(F.col("_changed"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in latest.columns else F.col(c)).alias(c)

    return joined.select([value(c) for c in [*current.columns, *[c for c in latest.columns if c not in current.columns]]])


def upsert_report(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """What an upsert would do: received, inserted, updated, repeated and errors (rows without a key), in one row."""
    counted = batch.groupBy(key).agg(F.count("*").alias("n"))
    stored = current.select(key).distinct().withColumn("_stored", F.lit(True))
    known = F.col(key).isNotNull()
    total = lambda what: F.coalesce(F.sum(what), F.lit(0).cast("long"))
    return counted.join(stored, key, "left").agg(
        total("n").alias("received"),
        F.count_if(known & F.col("_stored").isNull()).alias("inserted"),
        F.count_if(known & F.col("_stored").isNotNull()).alias("updated"),
        total(F.when(known, F.col("n") - 1)).alias("repeated"),
        total(F.when(~known, F.col("n"))).alias("errors"),
    )


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _folders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(stored).parquet(path) if existing(spark, [path]) else spark.createDataFrame([], stored)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Current documents, one per key."""
    return _folders(spark, path, schema).drop("bucket")


def write_batch(batch: DataFrame, path: str, schema: T.StructType, order: list[str], key: str = "_id") -> None:
    """Upsert a batch into the store at ``path``, whose documents have ``schema``.

    The merged folders are written beside the store first and then take the place
    of the old ones.  A writer that dies in between leaves them there, and the
    next write begins by finishing that one.
    """
    spark = batch.sparkSession
    pending = f"{path.rstrip('/')}_pending"
    _finish(spark, pending, path, schema)
    known = [f.name for f in schema.fields if f.name in batch.columns]
    touched = [r["bucket"] for r in batch.filter(F.col(key).isNotNull()).select(_bucket(key)).distinct().collect()]  # BUCKETS at most
    if not touched:
        return
    old = _folders(spark, path, schema).filter(F.col("bucket").isin(touched)).drop("bucket")
    merged = upsert(old, batch.select(known), key, order).select("*", _bucket(key))
    _write(merged.repartition("bucket"), pending, "overwrite")
    _finish(spark, pending, path, schema)


def _write(rows: DataFrame, path: str, mode: str, **options: str) -> None:
    rows.write.mode(mode).options(**options).partitionBy("bucket").parquet(path)


def _finish(spark: SparkSession, pending: str, path: str, schema: T.StructType) -> None:
    """Move folders that were written whole into the store; what was not written whole is dropped by the next write."""
    if existing(spark, [f"{pending}/_SUCCESS"]):
        _write(_folders(spark, pending, schema), path, "overwrite", partitionOverwriteMode="dynamic")
        files, where = file_system(spark, pending)
        files.delete(where, True)
