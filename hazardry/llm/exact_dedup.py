"""Exact duplicates by an extendible-hash index on shared files.

Texts are compared after lower-casing A-Z only; null counts as empty.  The key
of a text is a 64-bit hash.  One hash aggregation, combined before its shuffle,
compares the bytes of texts under the same key, so a text with a billion copies
reaches its task as one row per map task.  Its result, one entry per distinct
text, is the content of the index:

* the directory starts with one slot.  A bucket over its capacity splits on the
  next bit of the key, and the directory doubles when that bucket already used
  all its bits;
* each bucket, a range of keys, belongs to one owner task, which sorts its
  entries by key and chains different texts under one key;
* the buckets are written to the shared folder.

A document takes its slot from the first bits of its key, the bucket from the
directory, and from the bucket's entries under its key the link of the chain that
has its SHA-256; keep_id and group_size are those of that entry.  This is one
equi-join on bucket, key and SHA-256, so adaptive execution may split a hot entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardry.llm.common import free_names, lower_ascii, text_or_empty
from hazardry.sources.workspace import staged

CAPACITY = 1 << 16
MOST_BITS = 18


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", lower_ascii(text_or_empty()).alias("norm")).select(
        "doc_id", "norm", F.xxhash64("norm").alias("key")
    )


def _slot(bits: int):
    """The first bits of the key, in the key's unsigned order."""
    return F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")


def grow_directory(counts: dict[int, int], bits: int, capacity: int) -> list[tuple[int, int]]:
    """(prefix, local depth) of each bucket, split until none is over capacity or its bits are used up.

    `counts` has the entries of each prefix of `bits` bits that has any.
    """
    sums = [{} for _ in range(bits)] + [counts]
    for depth in range(bits, 0, -1):
        for prefix, n in sums[depth].items():
            sums[depth - 1][prefix >> 1] = sums[depth - 1].get(prefix >> 1, 0) + n
    buckets, overfull = [], [(0, 0)]
    while overfull:
        prefix, depth = overfull.pop()
        if depth < bits and sums[depth].get(prefix, 0) > capacity:
            overfull += [(prefix << 1, depth + 1), (prefix << 1 | 1, depth + 1)]
        else:
            buckets.append((prefix, depth))
    return sorted(buckets, key=lambda b: b[0] << (bits - b[1]))


def build_directory(entries: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """Slot to bucket, and the directory's depth.

    Only counts of prefixes reach the driver, 2**most_bits of them at most.  At
    that depth a bucket may stay over capacity; it is sorted and chained all
    the same, capacity only sets how the work is dealt out.
    """
    spark = entries.sparkSession
    n, bits = entries.count(), 0
    while bits < most_bits and (n >> bits) * 2 > capacity:
        bits += 1
    while True:
        counts = {r["slot"]: r["n"] for r in entries.groupBy(_slot(bits).alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if bits >= most_bits or max(counts.values(), default=0) <= capacity:
            break
        bits = min(most_bits, bits + 2)
    buckets = grow_directory(counts, bits, capacity)
    depth = max(d for _, d in buckets)
    slots = [
        (slot, bucket)
        for bucket, (prefix, local) in enumerate(buckets)
        for slot in range(prefix << (depth - local), (prefix + 1) << (depth - local))
    ]
    return spark.createDataFrame(slots, "slot long, bucket int"), depth


def _in_bucket(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Rows with the bucket that the directory names for their key's slot; 2**most_bits slots at most."""
    return rows.withColumn("slot", _slot(depth)).join(F.broadcast(directory), "slot").drop("slot")


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS
) -> tuple[DataFrame, DataFrame, int]:
    """The stored index (bucket, key, sha, keep_id, group_size, the entry's link in its chain), the directory and its depth."""
    entries = staged(
        _keyed(docs)
        .groupBy("key", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"),
        "dedup-entries",
    )
    directory, depth = build_directory(entries, capacity, most_bits)
    chain = Window.partitionBy("bucket", "key")
    index = staged(
        _in_bucket(entries, directory, depth)
        .repartition("bucket")
        .withColumn("link", F.row_number().over(chain.orderBy("sha")))
        .withColumn("links", F.count(F.lit(1)).over(chain))
        .sortWithinPartitions("bucket", "key", "link"),
        "dedup-index",
    )
    return index, directory, depth


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays.  Null ids are smaller
    than all others.  Of rows equal in id and text one is kept.  Other columns
    are not read.  An empty table gives no rows.
    """
    index, directory, depth = build_index(docs, capacity, most_bits)
    rows = (
        _keyed(docs)
        .select("doc_id", "key", F.unhex(F.sha2("norm", 256)).alias("sha"))
        .groupBy("doc_id", "key", "sha")
        .agg(F.count(F.lit(1)).alias("repeats"))
    )
    return (
        _in_bucket(rows, directory, depth)
        .join(index.select("bucket", "key", "sha", "keep_id", "group_size"), ["bucket", "key", "sha"])
        .withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    keep_id, keep_sha, own_sha = free_names(docs, "_id", "_sha", "_own_sha")
    kept = (
        exact_duplicates(docs)
        .filter("kept")
        .select(F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(keep_sha))
    )
    both = docs.withColumn(own_sha, F.sha2(lower_ascii(text_or_empty()), 256)).join(
        kept, F.col("doc_id").eqNullSafe(F.col(keep_id)) & (F.col(own_sha) == F.col(keep_sha))
    )
    return both.dropDuplicates([keep_id, keep_sha]).select(*docs.columns)
