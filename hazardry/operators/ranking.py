"""Per-group picks: first rows, last rows, samples.

Ranks with a constant bound are cut on the map side, so a group with a third of
all rows sends a few rows per task through the shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per(rows: DataFrame, keys: list[str], order: list, n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of every group with their ``rank`` from 1."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def keep_one(rows: DataFrame, key: str, order: list[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last in ``order``.

    Rows that tie in ``order`` are told apart by their other columns, in the
    order in which they stand, so the choice does not depend on the input's.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")
    others = [c for c in rows.columns if c != key and c not in order and not rows.schema[c].dataType.typeName() == "map"]
    ordering = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in [*order, *others]]
    return first_n_per(rows, [key], ordering, 1, "_rank").drop("_rank")


def sample_per_topic(messages: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` messages of every type in order of time, with the type's total."""
    totals = messages.groupBy("event_type").agg(F.count("*").alias("type_total"))
    picks = first_n_per(messages, ["event_type"], ["timestamp", "event_id"], n, "position")
    return picks.join(totals, "event_type")


_BUCKET_DIGITS = 4


def stratified_cap(rows: DataFrame, strata: list[str], target: Column, key: str = "event_id") -> DataFrame:
    """Keep ``target`` rows of every stratum, picked at random but repeatably.

    The order is that of the md5 of the key (then the key).  No stratum is sorted
    as a whole: rows are counted by the leading digits of the hash, the running
    count finds the one bucket in which the target is reached, and only that
    bucket is shuffled and ranked.  Counts are one row per stratum and bucket.

    ``target`` is an expression over the strata columns; where it is NULL the
    stratum stays whole.  The key must be unique.
    """
    hashed = rows.withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, _BUCKET_DIGITS)
    )
    histogram = hashed.groupBy(*strata, "_bucket").agg(F.count("*").alias("_n"))
    # at most 16 ** _BUCKET_DIGITS rows per stratum
    so_far = Window.partitionBy(*strata).orderBy("_bucket")
    cuts = (
        histogram.withColumn("_through", F.sum("_n").over(so_far))
        .withColumn("_target", F.coalesce(target.cast("long"), F.lit((1 << 63) - 1)))
        .withColumn("_before", F.col("_through") - F.col("_n"))
        .filter(F.col("_before") < F.col("_target"))
        .groupBy(*strata)
        .agg(
            F.max("_bucket").alias("_last_bucket"),
            (F.first("_target") - F.max("_before")).alias("_room"),
        )
        .withColumnsRenamed({c: f"_of_{c}" for c in strata})
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in strata])
    met = hashed.join(cuts, same)
    whole = met.filter(F.col("_bucket") < F.col("_last_bucket"))
    in_bucket = Window.partitionBy(*strata).orderBy("_hash", key)
    edge = (
        met.filter(F.col("_bucket") == F.col("_last_bucket"))
        .withColumn("_rank", F.row_number().over(in_bucket))
        .filter(F.col("_rank") <= F.col("_room"))
    )
    return whole.select(*rows.columns).unionByName(edge.select(*rows.columns))
