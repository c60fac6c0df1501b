"""Shards along a Hilbert curve through several metadata columns.

Each column is quantised by rank: its code is the share of rows with a smaller
value, in 2**bits steps, so any comparable type and any number of distinct
values will do and neighbouring codes hold neighbouring values.  Codes become
one curve index, rows are ordered by it, and the order is cut into runs of
equal row counts.  A run then covers a compact box of the columns, and the
minima and maxima in its file's footer let a reader skip it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import free_names, positions, text_or_empty
from hazardry.sources.workspace import staged

BITS = 10


def curve_table(dims: int) -> list[int]:
    """For state * 2**dims + corner: digit of the index | next state << dims.

    A state is an entry corner and a direction; the curve visits the corners of
    a cell in Gray-code order, turned by the state.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def ones(x: int) -> int:
        return 0 if not x & 1 else 1 + ones(x >> 1)

    gray = [i ^ (i >> 1) for i in range(size)]
    enters = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(size)]
    heads = [0 if w == 0 else ones(w - 1 if w % 2 == 0 else w) % dims for w in range(size)]
    table = []
    for state in range(dims * size):
        entry, head = state % size, state // size
        for corner in range(size):
            w = gray.index(turn(corner ^ entry, dims - (head + 1) % dims))
            entry2 = entry ^ turn(enters[w], head + 1)
            head2 = (head + heads[w] + 1) % dims
            table.append(w | (head2 * size + entry2) << dims)
    return table


def curve_index(codes: Sequence[Column], bits: int) -> Column:
    """Position on the Hilbert curve of a cell given by non-negative codes below 2**bits each."""
    dims = len(codes)
    state_bits = (dims * (1 << dims)).bit_length()
    if not 2 <= dims <= 4 or dims * bits + state_bits > 62:
        raise ValueError("a curve takes two to four columns and fits 62 bits with its state")
    table = F.array(*[F.lit(x) for x in curve_table(dims)])

    def step(path: Column, level: Column) -> Column:
        corner = reduce(
            lambda a, b: a + b,
            [F.call_function("shiftright", c, level).bitwiseAND(F.lit(1)) * F.lit(1 << k) for k, c in enumerate(codes)],
        )
        state = path.bitwiseAND(F.lit((1 << state_bits) - 1))
        turn = F.get(table, (state * (1 << dims) + corner).cast("int"))
        digit, after = turn.bitwiseAND(F.lit((1 << dims) - 1)), F.shiftright(turn, dims)
        return (F.shiftright(path, state_bits) * (1 << dims) + digit) * (1 << state_bits) + after

    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.shiftright(F.aggregate(levels, F.lit(0).cast("long"), step), state_bits)


def rank_codes(rows: DataFrame, column: str, n: int, bits: int = BITS) -> DataFrame:
    """Distinct values of a column with `code`: rows before the value, in 2**bits steps."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return positions(counts, [column], weight="_n").select(
        column, F.expr(f"cast(position * {1 << bits}L div {max(n, 1)}L as int)").alias("code")
    )


def _placed(docs: DataFrame, shards: int, dims: Sequence[str], bits: int, key: str) -> DataFrame:
    """key, size, text_crc32, curve, shard and slot of each row."""
    own = [d for d in dims if d != "size"]
    base = staged(
        docs.select(
            F.col(key).alias("_key"),
            *[F.col(d).alias(f"_dim_{d}") for d in own],
            (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
            F.crc32(text_or_empty()).alias("text_crc32"),
        ),
        "hilbert-base",
    )
    n = base.count()
    coded, codes = base, []
    for k, d in enumerate(dims):
        column = "size" if d == "size" else f"_dim_{d}"
        steps = rank_codes(base, column, n, bits).select(F.col(column).alias(f"_value{k}"), F.col("code").alias(f"_code{k}"))
        coded = coded.join(steps, F.col(column).eqNullSafe(F.col(f"_value{k}")))
        codes.append(F.col(f"_code{k}"))
    placed = positions(
        coded.select("_key", "size", "text_crc32", curve_index(codes, bits).alias("curve")),
        ["curve", "text_crc32", "size", "_key"],
    )
    shard = F.expr(f"cast(position * {shards}L div {max(n, 1)}L as int)")
    return placed.withColumn("shard", shard).select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        "shard",
        F.expr(f"position - (shard * {n}L + {shards - 1}L) div {shards}L").alias("slot"),
        "curve",
    )


def hilbert_shards(docs: DataFrame, shards: int = 8, dims: Sequence[str] = ("lang", "source", "size"), bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    `size` is the text's bytes plus one and may be named in `dims`, as may any
    column of documents.  The law is `rows`: counts of two shards differ by one
    at most.  Nulls in a dimension sort first and share one code.  Rows on one
    cell are ordered by checksum, size and id, so copies lie side by side.
    """
    return _placed(docs, shards, dims, bits, "doc_id").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, dims: Sequence[str] = ("lang", "source", "size"), bits: int = BITS) -> None:
    """Write all rows and columns of docs as Parquet, a folder per shard, in curve order.

    A file is a run of one shard, and the minima and maxima in its footer bound
    every dimension, so readers that filter on several of them skip files.
    Added are `size`, for such filters, and the folder `shard`; where docs has a
    column of such a name, an underscore goes before the added one.  An empty
    table writes an empty folder.  Repeated rows are written each.
    """
    row, shard, slot, size = free_names(docs, "__row", "shard", "__slot", "size")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "hilbert-rows")
    places = _placed(rows, shards, dims, bits, row).select(
        row, F.col("shard").alias(shard), F.col("slot").alias(slot), F.col("size").alias(size)
    )
    run = rows.join(places, row).drop(row).repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)
    run.drop(slot).write.partitionBy(shard).parquet(path)
