"""The keys that are stored, in folders by hash, each with a Bloom filter beside it.

A load asks the filters, a few bytes a key, which of its keys may be stored
already.  Those are looked up by an anti-join in the folders they fall into and,
while they are few, in the row groups around their hash; no other stored key is
read.  A key the filter rules out is new for certain, so the result is that of
an anti-join with all keys.

A filter is rows of 256 bits, four longs.  A key picks a row and two bits in each
of the longs by its hash.  Every load appends its rows; a stored key has all its
bits in one of them.  With KEYS_PER_ROW keys to a row on average about
one new key in 30,000 is taken for a stored one.  When there are more keys, or
many rows to combine, a new generation of the filters is written; only the former
reads the stored keys again, each time their number doubles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardry.sources.readers import existing, file_system
from hazardry.sources.workspace import range_tasks, scratch

BUCKETS = 8
FIRST_ROWS = 1 << 10
KEYS_PER_ROW = 8
MOST_PLACES = 1000

_WORDS = [f"word{i}" for i in range(4)]
_KEYS = "key string, place long, bucket int"
_FILTER = "block long, " + ", ".join(f"{w} long" for w in _WORDS) + ", bucket int"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _place(key: Column) -> Column:
    """The rest of the hash: picks the filter's row and orders stored keys."""
    return F.shiftrightunsigned(F.xxhash64(key), 8)


def _bits(key: Column) -> list[Column]:
    """Two bits in each of the four longs."""
    picks = F.xxhash64(F.lit(1), key)
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(picks, at).bitwiseAND(F.lit(63)).cast("int"))
    return [one(12 * i).bitwiseOR(one(12 * i + 6)).alias(w) for i, w in enumerate(_WORDS)]


@dataclass(frozen=True)
class KeySet:
    """Keys below one folder.  One loader at a time; a loader that died is followed by :meth:`rebuild`."""

    spark: SparkSession
    path: str
    first_rows: int = FIRST_ROWS

    def exists(self) -> bool:
        return bool(existing(self.spark, [f"{self.path}/keys"]))

    def stored(self) -> DataFrame:
        """key, place, bucket of all keys."""
        if not self.exists():
            return self.spark.createDataFrame([], _KEYS)
        return self.spark.read.schema(_KEYS).parquet(f"{self.path}/keys")

    def _generation(self) -> tuple[int, int] | None:
        """Number of the filters' generation and its rows per bucket, both in the folder's name."""
        files, root = file_system(self.spark, f"{self.path}/filter")
        if not files.exists(root):
            return None
        names = [s.getPath().getName() for s in files.listStatus(root)]
        return max((tuple(map(int, n.split("-"))) for n in names if n[:1].isdigit()), default=None)

    def filters(self) -> DataFrame:
        made = self._generation()
        if made is None:
            return self.spark.createDataFrame([], _FILTER)
        return self.spark.read.schema(_FILTER).parquet(f"{self.path}/filter/{made[0]}-{made[1]}")

    def _filter_rows(self, keys: DataFrame, rows: int) -> DataFrame:
        """Filter rows of a column `key`."""
        key = F.col("key")
        picked = keys.select(_bucket(key).alias("bucket"), F.pmod(_place(key), F.lit(rows)).alias("block"), *_bits(key))
        return self._combined(picked)

    @staticmethod
    def _combined(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])

    def possible(self, rows: DataFrame, key: str) -> DataFrame:
        """key, place and bucket of the rows whose key the filters do not rule out."""
        made = self._generation()
        if made is None:
            return self.spark.createDataFrame([], _KEYS)
        name = F.col(key)
        asked = rows.select(name.alias("key"), _place(name).alias("place"), _bucket(name).alias("bucket"), F.pmod(_place(name), F.lit(made[1])).alias("block"))
        held = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(bit) == bit for w, bit in zip(_WORDS, _bits(F.col("key")))])
        # the load that stored a key set all its bits in one row, so rows need not be combined first
        return asked.join(self.filters(), ["bucket", "block"]).filter(held).select("key", "place", "bucket").distinct()

    def unseen(self, rows: DataFrame, key: str, area: scratch) -> DataFrame:
        """Rows whose key is not stored.  `rows` is read twice: stage it if it is dear."""
        possible = area.staged(self.possible(rows, key))
        folders = [r["bucket"] for r in possible.select("bucket").distinct().collect()]  # BUCKETS at most
        if not folders:
            return rows
        stored = self.stored().filter(F.col("bucket").isin(folders))
        places = [r["place"] for r in possible.select("place").limit(MOST_PLACES + 1).collect()]
        if len(places) <= MOST_PLACES:  # row groups elsewhere are skipped; more are read by folder
            stored = stored.filter(F.col("place").isin(places))
        known = stored.join(possible.select("key"), "key", "left_semi").select(F.col("key").alias(key))
        return rows.join(known, key, "left_anti")

    def add(self, rows: DataFrame, key: str) -> None:
        """Store new keys, each once, and set their bits.  `rows` is read several times: stage it if it is dear."""
        keys = rows.select(F.col(key).alias("key"))
        self._write_keys(keys, "append")
        number, size = self._generation() or (0, self.first_rows)
        if self._needed(size) == size:
            self._write_filter(self._filter_rows(keys, size), number, size)
        self._grow(number, size)

    def rebuild(self, rows: DataFrame, key: str) -> None:
        """Forget everything and store the keys of `rows`."""
        self._write_keys(rows.select(F.col(key).alias("key")), "overwrite")
        number, size = self._generation() or (0, self.first_rows)
        size = self._needed(size)
        self._next(self._filter_rows(self.stored().select("key"), size), number, size)

    def _write_keys(self, keys: DataFrame, mode: str) -> None:
        key = F.col("key")
        placed = keys.select("key", _place(key).alias("place"), _bucket(key).alias("bucket"))
        order = ["bucket", "place"]
        ranged = placed.repartitionByRange(*range_tasks(keys.count()), *order).sortWithinPartitions(*order)
        ranged.write.mode(mode).partitionBy("bucket").parquet(f"{self.path}/keys")

    def _write_filter(self, rows: DataFrame, number: int, size: int) -> None:
        ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
        ordered.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/filter/{number}-{size}")

    def _needed(self, size: int) -> int:
        """Rows per bucket for the keys that are stored: `size`, or twice the next power that would do."""
        n, larger = self.stored().count(), size  # counts come from the footers
        while n > larger * BUCKETS * KEYS_PER_ROW:
            larger *= 2
        return size if larger == size else 2 * larger

    def _grow(self, number: int, size: int) -> None:
        """Keep the filters sparse and short."""
        larger = self._needed(size)
        if larger > size:
            self._next(self._filter_rows(self.stored().select("key"), larger), number, larger)
        elif self.filters().count() > 2 * size * BUCKETS:
            self._next(self._combined(self.filters()), number, size)

    def _next(self, rows: DataFrame, number: int, size: int) -> None:
        """Write a generation, then remove those before it."""
        self._write_filter(rows, number + 1, size)
        files, root = file_system(self.spark, f"{self.path}/filter")
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name[:1].isdigit() and int(name.split("-")[0]) <= number:
                files.delete(status.getPath(), True)
