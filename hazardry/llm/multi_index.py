"""Nearest neighbours by largest inner product, with an inverted multi-index.

A vector is cut into two halves, each quantised by centroids of its own, so a
few centroids make their square of cells.  A query ranks the centroids of each
half by distance (how far the inner product falls short of the best one) and a
heap gives the pairs in order of the summed distance, until the cells passed
hold enough entries; those are reranked by the inner product itself.

* Centroids are fitted by k-means on a sample of at most SAMPLE distinct
  vectors, those with the smallest hash.  Every vector is an entry.
* Enough is decided by measurement: TRIALS queries are compared with brute
  force over all entries, and the budget is the share of entries after which
  their true neighbours have come up at the rate RECALL.  Vectors without any
  structure need about half of all entries, clustered ones few.  A search then
  costs queries x share x entries.
* Equal vectors are one entry with its smallest ids, no more than an answer can
  hold, so a vector with a third of all rows costs one row; a query vector is
  searched once for all ids that have it.
* Cells have no cap.  Cells are laid out in their order into shards of at most
  `block` entries, and a cell above that is dealt over several shards.  A task
  holds one shard and streams the queries that go there past it.

To the driver come the sample, the counts of cells (at most CENTROIDS squared)
and the neighbours of the trials.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry.sources.workspace import staged

CENTROIDS = 64
SAMPLE = 1 << 14
ROUNDS = 10
TRIALS = 256
RECALL = 0.95
LEAST_BLOCK, MOST_BLOCK = 1 << 12, 1 << 18
SCORES_AT_ONCE = 1 << 22

KEY = ["key1", "key2"]
ENTRY = "key1 long, key2 long, vector array<{0}>, ids array<long>, cell int"


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, vector and its 128-bit key, for rows that can take part.

    Left out are rows without an id and vectors that are null, zero, of another
    length than most, or hold null or non-finite components.  Of several rows
    with one id the smallest vector is used.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    finite = lambda x: x.isNotNull() & (F.abs(x) < math.inf) & ~F.isnan(x)
    rows = rows.filter(F.col("id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    rows = rows.filter(F.size("vector") == (size["size"] if size else 0))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)))  # no -0.0
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    one = rows.join(twice, "id").groupBy("id").agg(F.min("vector").alias("vector"))
    rows = rows.join(twice, "id", "left_anti").unionByName(one)
    return rows.select("id", "vector", F.xxhash64("vector").alias("key1"), F.xxhash64(F.lit(1), "vector").alias("key2"))


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by Lloyd's rounds from k of the points; a centroid that loses all points stays where it is."""
    centres = points[np.random.default_rng(0).permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        owner = nearest_centre(points, centres)
        counts = np.bincount(owner, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Quantiser:
    """The centroids of both halves."""

    def __init__(self, sample: np.ndarray, centroids: int):
        self.cut = (sample.shape[1] + 1) // 2
        self.halves = [kmeans(half, centroids) for half in (sample[:, : self.cut], sample[:, self.cut :])]
        self.k = len(self.halves[1])

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        first, second = (nearest_centre(v, c) for v, c in zip((vectors[:, : self.cut], vectors[:, self.cut :]), self.halves))
        return first * self.k + second

    def traverse(self, query: np.ndarray) -> Iterator[int]:
        """All cells in order of summed distance: a heap holds the next pair of each opened row."""
        products = [c @ q for q, c in zip((query[: self.cut], query[self.cut :]), self.halves)]
        orders = [np.argsort(-p, kind="stable") for p in products]
        far1, far2 = ((p[o[0]] - p[o]).tolist() for p, o in zip(products, orders))
        rows, columns = (orders[0] * self.k).tolist(), orders[1].tolist()
        heap = [(far1[0] + far2[0], 0, 0)]
        while heap:
            _, i, j = heap[0]
            yield rows[i] + columns[j]
            if j + 1 < len(far2):
                heapq.heapreplace(heap, (far1[i] + far2[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            if j == 0 and i + 1 < len(far1):
                heapq.heappush(heap, (far1[i + 1] + far2[0], i + 1, 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best(scores: np.ndarray, first_ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by the smaller id; places at minus infinity do not count."""
    places = np.flatnonzero(scores > -np.inf)
    if len(places) > k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= least]
    return places[np.lexsort((first_ids[places], -scores[places]))][:k]


class Shard:
    """Entries of one shard, cell by cell, and the search among those of given cells."""

    def __init__(self, cells: np.ndarray, vectors: np.ndarray, ids: list[list[int]]):
        order = np.argsort(cells, kind="stable")
        self.vectors = vectors[order]
        self.ids = [ids[i] for i in order.tolist()]
        self.first = np.array([x[0] for x in self.ids], np.int64)
        names, starts = np.unique(cells[order], return_index=True)
        self.runs = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)])))

    def search(self, queries: np.ndarray, cells: list[np.ndarray], k: int) -> Iterator[list[tuple[int, float]]]:
        """For each query the k nearest (id, score), nearest first, ties to smaller ids."""
        step = max(1, SCORES_AT_ONCE // max(1, len(self.first)))
        for at in range(0, len(queries), step):
            some = queries[at : at + step]
            probes = cells[at : at + step]
            scores = np.full((len(some), len(self.first)), -np.inf)
            who = np.repeat(np.arange(len(some)), [len(c) for c in probes])
            cell = np.concatenate([*probes, np.empty(0, np.int64)]).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            names, starts = np.unique(cell[order], return_index=True)
            for name, asking in zip(names.tolist(), np.split(who[order], starts[1:])):
                if name in self.runs:
                    low, high = self.runs[name]
                    scores[asking, low:high] = some[asking] @ self.vectors[low:high].T
            for query, row in zip(some, scores):
                places = best(row, self.first, k)
                exact = (self.vectors[places] * query).sum(axis=1).tolist()
                found = [(-s, i) for p, s in zip(places.tolist(), exact) for i in self.ids[p]]
                yield [(i, -s) for s, i in heapq.nsmallest(k, found)]


def smallest(entries: DataFrame, n: int, most: int, by: list[str]) -> DataFrame:
    """`most` of n entries, those with the smallest hash; tasks send on about twice as many in all."""
    span = 1 << 30
    if n > 2 * most:
        entries = entries.filter(F.pmod(by[0], F.lit(span)) < 2 * most * span // n)
    return entries.orderBy(F.pmod(by[0], F.lit(span)), *by).limit(most)


def _fit(entries: DataFrame, centroids: int, sample: int) -> Quantiser | None:
    rows = smallest(entries, entries.count(), sample, KEY).select("vector").toArrow()["vector"].combine_chunks()
    return Quantiser(_matrix(rows), centroids) if len(rows) else None


def build_index(rows: DataFrame, k: int, centroids: int = CENTROIDS, sample: int = SAMPLE) -> tuple[DataFrame, Quantiser | None]:
    """The stored entries, one per distinct vector with its k smallest ids and its cell, and the quantiser."""
    kind = dict(rows.dtypes)["vector"][6:-1]
    own = Window.partitionBy(*KEY).orderBy("id")
    entries = staged(
        rows.withColumn("place", F.row_number().over(own))
        .filter(F.col("place") <= k)
        .groupBy(*KEY)
        .agg(F.any_value("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")),
        "index-entries",
    )
    quantiser = _fit(entries, centroids, sample)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = quantiser.cells(_matrix(batch.column("vector"))) if batch.num_rows else np.empty(0)
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    if quantiser is None:
        return entries.withColumn("cell", F.lit(0)), None
    return staged(entries.mapInArrow(assign, ENTRY.format(kind)), "index-cells"), quantiser


def true_neighbours(entries: DataFrame, trials: dict[int, tuple[tuple[int, int], np.ndarray]], k: int) -> DataFrame:
    """Brute force: trial, cell and rank of the k entries nearest to each trial, itself left out."""
    queries = np.array([v for _, v in trials.values()])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = queries @ _matrix(batch.column("vector")).T
            first = np.array([x[0] for x in batch.column("ids").to_pylist()], np.int64)
            keys = list(zip(*(batch.column(c).to_pylist() for c in KEY)))
            cell = batch.column("cell").to_pylist()
            out = [
                (t, cell[p], float(row[p]), int(first[p]))
                for (t, (key, _)), row in zip(trials.items(), scores)
                for p in best(row, first, k + 1).tolist()
                if keys[p] != key
            ]
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.int64())], names=["trial", "cell", "score", "id"])

    near = entries.mapInArrow(scan, "trial long, cell long, score double, id long")
    rank = F.row_number().over(Window.partitionBy("trial").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)


def probe_share(entries: DataFrame, quantiser: Quantiser, sizes: np.ndarray, k: int, recall: float = RECALL, trials: int = TRIALS) -> float:
    """The share of entries after which `recall` of the trials' true neighbours have come up."""
    table = smallest(entries, int(sizes.sum()), trials, KEY[::-1]).select(*KEY, "vector").toArrow()
    keys = list(zip(*(table[c].to_pylist() for c in KEY)))
    asked = dict(enumerate(zip(keys, _matrix(table["vector"].combine_chunks()))))
    before = {}
    for t, (_, query) in asked.items():
        order = np.fromiter(quantiser.traverse(query), np.int64)
        seen = np.empty(len(sizes))
        seen[order] = np.cumsum(sizes[order]) - sizes[order]
        before[t] = seen
    needs = [before[r["trial"]][r["cell"]] for r in true_neighbours(entries, asked, k).select("trial", "cell").collect()]
    return (float(np.quantile(needs, recall)) + 1) / max(1, sizes.sum()) if needs else 1.0


def layout(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First shard and number of shards of each cell, and how many shards there are."""
    first, parts, shard, filled = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for cell, n in enumerate(sizes.tolist()):
        if filled and filled + n > block:
            shard, filled = shard + 1, 0
        first[cell], parts[cell] = shard, max(1, -(-n // block))
        shard += int(parts[cell]) - 1
        filled = filled + n if parts[cell] == 1 else block
    return first, parts, shard + 1


def nearest(
    vectors: DataFrame,
    k: int = 20,
    query_step: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    centroids: int = CENTROIDS,
    recall: float = RECALL,
    block: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id is divisible by `query_step`.

    Candidates are all rows that can take part (see `usable`) but the query's
    own; ties go to the smaller id.  The score is the inner product of the
    vectors as given, in double precision.  A table with no more than 4 (k + 1)
    distinct vectors is searched whole.  Other columns are not read; an empty
    table gives no rows.
    """
    rows = staged(usable(vectors, id, vector), "index-rows")
    entries, quantiser = build_index(rows, k + 1, centroids)
    asking = rows.filter(F.col("id") % query_step == 0)
    if quantiser is None:
        return asking.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    sizes = np.zeros(len(quantiser.halves[0]) * quantiser.k, np.int64)
    for r in entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["cell"]] = r["n"]
    n = int(sizes.sum())
    budget = max(probe_share(entries, quantiser, sizes, k, recall) * n, 4 * (k + 1))
    first, parts, shards = layout(sizes, block or min(max(n // 12, LEAST_BLOCK), MOST_BLOCK))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query goes to each shard that has cells of its path, with the cells there."""
        for batch in batches:
            if not batch.num_rows:
                continue
            row, shard, cells = [], [], []
            for i, query in enumerate(_matrix(batch.column("vector"))):
                path, seen = [], 0
                for cell in quantiser.traverse(query):
                    if seen >= budget:
                        break
                    if sizes[cell]:
                        path.append(cell)
                        seen += sizes[cell]
                path = np.array(path, np.int64)
                more = parts[path].max(initial=1)
                at = np.concatenate([first[path[parts[path] > s]] + s for s in range(more)])
                path = np.concatenate([path[parts[path] > s] for s in range(more)])
                order = np.argsort(at, kind="stable")
                names, starts = np.unique(at[order], return_index=True)
                for name, some in zip(names.tolist(), np.split(path[order], starts[1:])):
                    row.append(i)
                    shard.append(name)
                    cells.append(some)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), *(taken.column(c) for c in (*KEY, "vector")), pa.array(cells, pa.list_(pa.int64()))],
                names=["shard", *KEY, "vector", "list"],
            )

    kind = dict(rows.dtypes)["vector"]
    queries = asking.groupBy(*KEY).agg(F.any_value("vector").alias("vector"))
    probes = queries.mapInArrow(probe, f"shard int, key1 long, key2 long, vector {kind}, list array<long>")
    spread = entries.sparkSession.createDataFrame(
        [(c, int(first[c]), int(parts[c])) for c in np.flatnonzero(sizes).tolist()], "cell int, first int, parts int"
    )
    dealt = entries.join(F.broadcast(spread), "cell").select(  # a row per cell, centroids squared at most
        (F.col("first") + F.pmod("key1", "parts")).cast("int").alias("shard"), F.col("cell").alias("kind"), *KEY, "vector", F.col("ids").alias("list")
    )
    both = dealt.unionByName(probes.withColumn("kind", F.lit(len(sizes))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of a shard come first, by cell, then the queries that probe it."""
        held, index, current = [], None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            query = batch.column("kind").to_numpy() == len(sizes)
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if shard[low] != current:
                    held, index, current = [], None, shard[low]
                if not query[low]:
                    held.append((part.column("kind").to_numpy(), _matrix(part.column("vector")), part.column("list").to_pylist()))
                    continue
                if index is None:
                    cells, points, ids = zip(*held)
                    index, held = Shard(np.concatenate(cells), np.concatenate(points), [x for some in ids for x in some]), []
                asked = [np.array(x, np.int64) for x in part.column("list").to_pylist()]
                found = list(index.search(_matrix(part.column("vector")), asked, k + 1))
                times = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                flat = [x for some in found for x in some]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key1").take(times), part.column("key2").take(times), pa.array([i for i, _ in flat], pa.int64()), pa.array([s for _, s in flat], pa.float64())],
                    names=[*KEY, "id", "score"],
                )

    found = (
        both.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(search, "key1 long, key2 long, id long, score double")
    )
    order: list[Column] = [F.desc("score"), F.asc("id")]
    nearest_of = (
        found.withColumn("place", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))
        .filter(F.col("place") <= k + 1)
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("near"))
    )
    answer = asking.select(F.col("id").alias("query_id"), *KEY).join(nearest_of, KEY)
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return answer.select("query_id", F.posexplode(others).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score")
    )
