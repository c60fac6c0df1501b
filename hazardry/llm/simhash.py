"""Near duplicates by SimHash fingerprints, searched in BK-trees.

A fingerprint has 64 bits; bit k is set if it is set in more than half of the
hashes of the text's word shingles.  Two texts are linked if their fingerprints
differ in at most RADIUS bits, and links make components.

Fingerprints within RADIUS of each other agree in one of RADIUS + 1 bands of
bits.  Every distinct fingerprint goes to one shard per band, keyed by the
band's value, and each shard has a BK-tree: a node's children hang on edges
numbered by their Hamming distance to it, and a search follows only the edges
whose number differs from the query's own distance by RADIUS or less.

The trees travel with their shard and are not broadcast, as their total grows
with the corpus.  A shard of any size is cut into blocks of about BLOCK
members; each pair of blocks is a group of its own, with a tree of the one
searched for the other, so memory is bounded however many fingerprints share a
band.  A task unites what it finds and emits at most one edge per fingerprint
and group, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import free_names, text_or_empty
from hazardry.llm.components import components
from hazardry.sources.workspace import staged

SEED = 42
WORDS = 3
RADIUS = 2
BLOCK = 1 << 15
PAIRS_AT_ONCE = 1 << 20
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> bytes:
    """The fingerprint as 8 bytes, most significant first; zero for a text without words."""
    own = text.lower().split()
    if not own:
        return bytes(8)
    n = max(1, len(own) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = own[at : at + SHINGLES_AT_ONCE + words - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words)])) if len(own) > words else [b" ".join(own)]
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n).tobytes()


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join(fingerprint(t.as_py(), words) for t in batch.column(1))
            signed = np.frombuffer(prints, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])

    source = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


class Forest:
    """BK-trees of many shards at once, in arrays; the first member of a shard is its root."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray):
        """`shard` numbers the tree of each print, from 0, all of them used."""
        self.prints = prints
        n = len(prints)
        edge_keys, nodes = [], []
        left, group = np.arange(n), shard.astype(np.int64)
        self.roots = None
        keys = group
        while len(left):
            order = np.argsort(keys, kind="stable")
            left, keys = left[order], keys[order]
            first = np.ones(len(keys), bool)
            first[1:] = keys[1:] != keys[:-1]
            node = left[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
            if self.roots is None:
                self.roots = left[first]
            else:
                edge_keys.append(keys[first])
                nodes.append(left[first])
            rest = ~first
            left, node = left[rest], node[rest]
            keys = node * 65 + np.bitwise_count(prints[left] ^ prints[node])
        self.edges = np.concatenate(edge_keys) if edge_keys else np.zeros(0, np.int64)
        self.nodes = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(self.edges, kind="stable")
        self.edges, self.nodes = self.edges[order], self.nodes[order]

    def search(self, queries: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) within the radius, in portions; only edges within the radius of the distance are followed."""
        stack = [(np.arange(len(queries)), self.roots[shard])]
        while stack:
            q, node = stack.pop()
            if len(q) > PAIRS_AT_ONCE:
                stack += [(q[PAIRS_AT_ONCE:], node[PAIRS_AT_ONCE:])]
                q, node = q[:PAIRS_AT_ONCE], node[:PAIRS_AT_ONCE]
            d = np.bitwise_count(queries[q] ^ self.prints[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0), "left")
            many = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right") - low
            if total := int(many.sum()):
                start = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
                stack.append((np.repeat(q, many), self.nodes[start + np.arange(total)]))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unions of a[i] and b[i] in place; a root is the smallest of its set."""
    while len(a):
        for side in (a, b):
            while True:
                up = parent[side]
                if (up == side).all():
                    break
                side[:] = parent[up]
        apart = a != b
        a, b = a[apart].copy(), b[apart].copy()
        if len(a):
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _flat(parent: np.ndarray) -> np.ndarray:
    while not (parent[parent] == parent).all():
        parent = parent[parent]
    return parent


def tree_edges(members: np.ndarray, member_shard: np.ndarray, queries: np.ndarray, query_shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(print, print) pairs that connect what is linked across queries and members of the same shard."""
    forest = Forest(members, member_shard)
    nodes, place = np.unique(np.concatenate([members, queries]), return_inverse=True)
    member_at, query_at = place[: len(members)], place[len(members) :]
    # A set never spans two shards of one band, as shards of a band share no fingerprint.
    parent = np.arange(len(nodes))
    for q, m in forest.search(queries, query_shard, radius):
        unite(parent, query_at[q].copy(), member_at[m].copy())
    parent = _flat(parent)
    moved = np.nonzero(parent != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[parent[moved]]


def _bands(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of radius + 1 bands that cover 64 bits."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


_GROUP = ("band", "value", "low", "high")


def _search_shards(radius: int):
    """Over rows sorted by group: trees of the rows marked `member`, searched for those marked `ask`."""

    def edges(rows: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(rows)
        fp = t.column("fp").to_numpy().view(np.uint64)
        key = np.stack([t.column(c).to_numpy() for c in _GROUP])
        new = np.ones(len(fp), bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        shard = np.cumsum(new) - 1
        band = key[0]
        member, asks = (t.column(c).to_numpy() for c in ("member", "ask"))
        pairs = []
        for b in np.unique(band):
            own = band == b
            s = np.unique(shard[own & member], return_inverse=True)
            numbers = np.full(int(shard.max()) + 1, -1)
            numbers[s[0]] = np.arange(len(s[0]))
            ask = own & asks & (numbers[shard] >= 0)
            pairs.append(tree_edges(fp[own & member], s[1], fp[ask], numbers[shard[ask]], radius))
        a, b = (np.concatenate([p[k] for p in pairs]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            same = np.ones(len(batch), bool)
            for name in _GROUP:
                column = batch.column(name).to_numpy()
                same &= column == column[-1]
            cut = len(batch) - int(same.sum())
            if cut and size + cut >= BLOCK:
                yield edges([*kept, table.slice(0, cut)])
                kept, size, table = [], 0, table.slice(cut)
            kept.append(table)
            size += len(table)
        if kept:
            yield edges(kept)

    return run


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what links of the radius connect.

    `prints` has distinct longs in `fp`.
    """
    shards = staged(
        prints.select(
            "fp",
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(k).alias("band"),
                            F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1)).alias("value"),
                        )
                        for k, (low, width) in enumerate(_bands(radius))
                    ]
                )
            ).alias("s"),
        ).select("s.band", "s.value", "fp"),
        "simhash-shards",
    )
    sizes = (
        shards.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("blocks", F.expr(f"(n + {block - 1}) div {block}"))
    )
    members = shards.join(sizes, ["band", "value"]).withColumn("own", F.expr("pmod(xxhash64(fp), blocks)"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        members.withColumn("other", other)
        .select(
            "band",
            "value",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "fp",
            (F.col("own") <= F.col("other")).alias("member"),
            (F.col("own") >= F.col("other")).alias("ask"),
        )
        .repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP)
        .mapInArrow(_search_shards(radius), "a long, b long")
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id.

    Null and empty texts have fingerprint zero and are linked like any other.
    component_id is the smallest doc_id that can be reached; null ids are passed
    over unless a component has no other.  Repeated rows are rows of their own.
    Other columns are not read; an empty table gives no rows.
    """
    own = staged(fingerprints(docs, words), "simhash-prints")
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(least.select("fp"), radius, block))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    return own.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Of each component the documents with the smallest id, with all their columns."""
    kept = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    (keep_id,) = free_names(docs, "_id")
    return docs.join(kept.withColumnRenamed("doc_id", keep_id), F.col("doc_id").eqNullSafe(F.col(keep_id)), "left_semi")
