"""Benchmark passages in documents, by winnowed fingerprints.

Words are runs of digits, a-z (A-Z lower-cased) and characters outside ASCII.  A
window is WINDOW consecutive words of an item; a shorter item is one window.

A text's fingerprints are the smallest hash, the rightmost of equal ones, of
every WINDOW - K + 1 consecutive k-grams.  Two texts that share WINDOW words
share such a stretch and so its fingerprint, whatever stands around it.  Equal
fingerprints are then extended to both sides, word by word, which decides
exactly.  An item shorter than a window has one k-gram, itself, and every
document k-gram of that length is compared with it.

Documents are not shuffled.  The items go to the documents, in blocks of
bounded size: each block is broadcast and one pass marks its hits in a bit map
that travels with the row.  Between every few blocks rows are written down, so
that few blocks are in memory at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import text_or_empty
from hazardry.sources.workspace import staged

WINDOW = 10
K = 5
BLOCK_BYTES = 16 << 20
BLOCKS_AT_ONCE = 4

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive word numbers."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ x[j : j + n]) * _ODD
        h ^= h >> np.uint64(29)
    return h


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the smallest hash, rightmost of equal ones, of every `width` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = hashes[width - 1 :].copy()
    place = np.full(n, width - 1)
    for j in range(width - 2, -1, -1):
        smaller = hashes[j : j + n] < least
        least[smaller] = hashes[j : j + n][smaller]
        place[smaller] = j
    return np.unique(place + np.arange(n))


class Items:
    """Fingerprints of a block of benchmark items, and the search of one document against them."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW, k: int = K):
        self.window, self.k = window, k
        self.number: dict[bytes, int] = {}
        self.ids: list[str] = []
        self.texts: list[np.ndarray] = []
        for item_id, text in items:
            if own := words(text):
                self.ids.append(item_id)
                self.texts.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in own], np.int64))
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found: dict[int, list[np.ndarray]] = {}
        for i, own in enumerate(self.texts):
            long = len(own) >= window
            size = k if long else len(own)
            hashes = gram_hashes(own, size)
            for at in winnow(hashes, window - k + 1) if long else [0]:
                found.setdefault(0 if long else size, []).append((hashes[at], i, at))
        for size, rows in found.items():
            rows.sort()
            self.tables[size] = (
                np.array([r[0] for r in rows], np.uint64),
                np.array([r[1:] for r in rows], np.int64),
            )

    def search(self, own: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words of a document are hit, and by which items."""
        hit, items = np.zeros(len(own), bool), set()
        doc = np.fromiter(map(self.number.get, own, repeat(0)), np.int64, len(own))
        for size, (hashes, targets) in self.tables.items():
            grams = gram_hashes(doc, size or self.k)
            places = winnow(grams, self.window - self.k + 1) if size == 0 else np.arange(len(grams))
            first = np.searchsorted(hashes, grams[places])
            known = first < len(hashes)
            known[known] = hashes[first[known]] == grams[places[known]]
            seen: dict[tuple[int, int], int] = {}
            for at, row in zip(places[known].tolist(), first[known].tolist()):
                value = hashes[row]
                while row < len(hashes) and hashes[row] == value:
                    item, q = targets[row].tolist()
                    row += 1
                    if at < seen.get((item, at - q), -1):
                        continue
                    left, right = self._extend(doc, self.texts[item], at, q)
                    seen[item, at - q] = right
                    if right - left >= (self.window if size == 0 else size):
                        hit[left:right] = True
                        items.add(item)
        return hit, items

    @staticmethod
    def _extend(doc: np.ndarray, item: np.ndarray, at: int, q: int) -> tuple[int, int]:
        """The longest equal stretch around doc[at] and item[q]; empty if these differ."""
        back = min(at, q)
        same = doc[at - back : at][::-1] == item[q - back : q][::-1]
        left = back if same.all() else int(np.argmin(same))
        ahead = min(len(doc) - at, len(item) - q)
        same = doc[at : at + ahead] == item[q : q + ahead]
        right = ahead if same.all() else int(np.argmin(same))
        return (at - left, at + right) if right else (at, at)


def _marking(broadcast):
    """A pass over Arrow batches: adds a block's hits to `hits` and the ids of its items to `items`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(broadcast.value)
        for batch in batches:
            spot = batch.schema.get_field_index
            counts, sums, hits, items = [], [], [], []
            for text, before, names in zip(
                batch.column(spot("__text")), batch.column(spot("__hits")).to_pylist(), batch.column(spot("__items")).to_pylist()
            ):
                own = words(text.as_py())
                hit, found = index.search(own)
                if before is not None:
                    hit |= np.unpackbits(np.frombuffer(before, np.uint8), count=len(own)).astype(bool)
                counts.append(len(own))
                sums.append(int(hit.sum()))
                hits.append(np.packbits(hit).tobytes() if hit.any() else None)
                items.append(sorted({*(names or ()), *(index.ids[i] for i in found)}))
            columns = {
                "__words": pa.array(counts, pa.int64()),
                "__n_hit": pa.array(sums, pa.int64()),
                "__hits": pa.array(hits, pa.binary()),
                "__items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(
                [columns.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)], names=batch.schema.names
            )

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items one block at a time; the driver holds one partition and one block of them."""
    block, size = [], 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), text_or_empty().cast("binary"))
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, bytes(text)))
        size += len(text)
    if block:
        yield block


def mark_items(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of docs with __words and __n_hit (counts), __hits (bit map of hit
    words, null if none), __items.

    Null and empty texts have no words.  Repeated rows and ids are separate
    rows.  Items without words match nothing; a null item_id counts as the empty
    one; item ids that repeat are listed once.  No items leave docs without
    hits.
    """
    added = {"__words": "bigint", "__n_hit": "bigint", "__hits": "binary", "__items": "array<string>"}
    marked = docs.select(
        "*",
        text_or_empty().cast("binary").alias("__text"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in added.items()],
    )
    spark = docs.sparkSession
    done = 0
    for block in _blocks(items, block_bytes) if items.take(1) else [[]]:
        marked = marked.mapInArrow(_marking(spark.sparkContext.broadcast(block)), marked.schema)
        done += 1
        if done % BLOCKS_AT_ONCE == 0:
            marked = staged(marked, "decontaminate")
    return marked.drop("__text")


def contamination(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark_items(docs.select("doc_id", "text"), items, block_bytes)
    names = F.array_join(F.array_sort("__items"), ",")
    n_hit = F.col("__n_hit")
    return marked.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents no window of an item occurs in, with all their columns."""
    own = ["text" if c == "text" else f"column{k}" for k, c in enumerate(docs.columns)]  # none is a name of mark_items
    return mark_items(docs.toDF(*own), items).filter("__hits is null").select(*own).toDF(*docs.columns)

