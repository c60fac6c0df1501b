"""What several corpus operators share: ASCII case folding, folds by checksum, exact positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry.sources.workspace import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.  Texts of one-byte characters need no table."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; an id of null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def free_names(rows: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until no column of `rows` has it."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def positions(rows: DataFrame, order: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows with `position`: how many rows (or how much weight) stand before each in the given order.

    A range partitioning sorts them, the place inside a partition comes from the
    row's own number there, and only one count per partition meets in one task.
    Rows are written before they are numbered, so every later read agrees.
    `order` should end with a key that tells rows apart; rows equal in all of
    it take neighbouring positions in any order.  Nulls come first.
    """
    part = F.shiftright("_serial", 33)
    kept = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_serial", F.monotonically_increasing_id()),
        "positions",
    )
    own = F.count(F.lit(1)) if weight is None else F.sum(weight)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        kept.groupBy(part.alias("_part"))
        .agg(own.alias("_own"))
        .select("_part", F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_base"))
    )
    if weight is None:
        inside = F.col("_serial").bitwiseAND(F.lit((1 << 33) - 1))
    else:
        earlier = Window.partitionBy("_part").orderBy("_serial").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(bases), "_part")  # one row per partition
        .withColumn("position", F.col("_base") + inside)
        .drop("_part", "_base", "_serial")
    )
