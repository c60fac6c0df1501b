"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.sources.workspace import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a > b)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return (
        large.join(least, "a")
        .filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that can be reached; nodes without edges are not listed.

    `edges` has two columns of one comparable type, in any direction, repeats
    and loops included.  Each round is written down; the rounds end when the
    edges stay the same, all pointing at roots.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = staged(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "edges"
    )

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    seen = mark(now)
    while True:
        now = staged(_stars(now), "edges")
        if (mine := mark(now)) == seen:
            break
        seen = mine
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
