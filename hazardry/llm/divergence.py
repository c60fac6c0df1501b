"""How far the word use of sources differs: iceberg prefix refinement, then exact smoothed shares.

A term is a run of letters (A-Z, a-z, lower-cased, and every character outside
ASCII).  A language keeps the terms that stand in at least LEAST of its
documents.  They are found by growing byte prefixes level by level:

* A task reads its texts once and notes the terms of every document and how often
  they occur, added up in the task.  The terms of a document are sorted, so a term
  also knows how many levels of prefix it shares with the one before it; a prefix
  of some level is counted once per document, at the first term that brings it.
* Level by level, prefixes of 4, 8, 16, ... bytes are counted by distinct
  documents, and those below LEAST are discarded.  The next level reads only
  terms below a prefix that is left, so the rare tail of the vocabulary is
  shuffled as a few short prefixes.  A term shorter than the level's length is
  complete; a complete one that is left is kept.
* Prefixes that are left are broadcast while they are few (MOST_BROADCAST) and
  joined by key beyond that.

Distances of sources sum over all kept terms.  A task takes a share of a
language's terms, as a matrix of sources by terms of CELLS cells or the square of
the sources, whichever is more, so its sums are no more rows than it reads.  The
sums of tasks are added by key.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardry.sources.workspace import ROWS_PER_TASK, staged

LEAST = 30
PRIOR = 5
UNIT = 1_000_000_000
TOP = 50
FIRST_LEVEL = 4
MOST_BROADCAST = 200_000
NOTES_AT_ONCE = 200_000
HELD = 2_000_000
CELLS = 1 << 15
TASKS_PER_CORE = 4
LEVELS = 64  # more than the levels of a text of 2 GB, the longest

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NOTES = "lang string, source string, term binary, shared int, docs long, n long"
_KEYS = ["lang", "source", "term", "shared"]


def shared_levels(terms: list[bytes], new: np.ndarray) -> np.ndarray:
    """How many levels of prefix each term shares with the one before it; none where a document is `new`."""
    if not terms:
        return np.empty(0, np.int32)
    heads = np.array(terms, "S16").view(np.uint8).reshape(len(terms), 16)  # terms hold no zero bytes
    shared, width = np.zeros(len(terms), np.int32), FIRST_LEVEL
    same = ~new
    while width <= 16:
        same[1:] &= (heads[1:, :width] == heads[:-1, :width]).all(axis=1) & (heads[1:, width - 1] > 0)
        shared += same
        width *= 2
    for i in np.flatnonzero(same).tolist():
        longer = width
        while len(terms[i]) >= longer and terms[i][:longer] == terms[i - 1][:longer]:
            shared[i], longer = shared[i] + 1, longer * 2
    return shared


def _added(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["key", "term"], use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select(["key", "term", "docs", "n"])


def term_notes(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, shared) with its documents and occurrences, added up in each task; a group has a row without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}  # the task's groups; rows hold group * LEVELS + shared
        tables: list[pa.Table] = []
        for part in parts(batches, numbers):
            tables.append(part)
            if sum(t.num_rows for t in tables) > held:
                tables = [_added(tables)]
                if tables[0].num_rows > held // 2:
                    yield from named(tables.pop(), numbers)
        if tables:
            tables = [_added(tables)]
            yield from named(tables.pop(), numbers)
        pa.default_memory_pool().release_unused()  # the worker stays for later stages

    def named(table: pa.Table, numbers: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([g[i] for g in numbers], pa.string()) for i in (0, 1))
        for batch in table.to_batches(NOTES_AT_ONCE):
            group, shared = np.divmod(batch.column("key").to_numpy(), LEVELS)
            group = pa.array(group)
            columns = [langs.take(group), sources.take(group), batch.column("term"), pa.array(shared.astype(np.int32)), batch.column("docs"), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, [*_KEYS, "docs", "n"])

    def parts(batches: Iterator[pa.RecordBatch], numbers: dict[tuple[str, str], int]) -> Iterator[pa.Table]:
        for batch in batches:
            owners = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            groups = np.array([numbers.setdefault(g, len(numbers)) for g in owners], np.int64)
            terms, n, sizes = [], [], []
            for at, text in enumerate(batch.column(2)):
                counts = Counter(_TERM.findall(text.as_py().lower()))  # bytes: only A-Z change
                own = sorted(counts)
                terms += own
                n += map(counts.__getitem__, own)
                sizes.append(len(own))
                if len(terms) > NOTES_AT_ONCE or at == batch.num_rows - 1:
                    yield noted(groups[at + 1 - len(sizes) : at + 1], terms, n, np.array(sizes))
                    terms, n, sizes = [], [], []

    def noted(groups: np.ndarray, terms: list[bytes], n: list[int], sizes: np.ndarray) -> pa.Table:
        new = np.zeros(len(terms), bool)
        new[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        none = np.unique(groups)  # a row without a term for each group
        columns = {
            "key": pa.array(np.concatenate([np.repeat(groups, sizes) * LEVELS + shared_levels(terms, new), none * LEVELS])),
            "term": pa.array(terms + [None] * len(none), pa.binary()),
            "docs": pa.array(np.ones(len(terms) + len(none), np.int64)),
            "n": pa.array(n + [0] * len(none), pa.int64()),
        }
        return pa.table(columns)

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, _NOTES)


def _gathered(df: DataFrame, purpose: str, rows: int) -> DataFrame:
    """Staged by a few tasks a core, however many partitions the session shuffles into: a file and a task each have buffers.

    ``rows`` of input keep as many tasks as they need at ROWS_PER_TASK.
    """
    fewest = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return staged(df.coalesce(max(fewest, rows // ROWS_PER_TASK)), purpose)


def _head(width: int) -> Column:
    return F.substring("term", 1, width)


def _sized(rows: DataFrame, n: int, most: int) -> DataFrame:
    """To be broadcast if it is few rows; joined by key otherwise."""
    return F.broadcast(rows) if n <= most else rows


def kept_terms(notes: DataFrame, least: int = LEAST, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """lang and term of the terms in at least `least` documents of their language."""
    whole: list[DataFrame] = []
    rows = notes.count()
    below, level, width = notes.filter(F.col("term").isNotNull()), 0, FIRST_LEVEL
    while True:
        complete = F.octet_length("term") < width
        counted = (
            below.filter(complete | (F.col("shared") <= level))
            .groupBy("lang", _head(width).alias("head"), complete.alias("complete"))
            .agg(F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= least)
            .select("lang", "head", "complete")
        )
        left = _gathered(counted, "terms-level", rows)
        whole.append(left.filter("complete").select("lang", F.col("head").alias("term")))
        open_heads = left.filter("not complete").select(F.col("lang").alias("_lang"), F.col("head").alias("_head"))
        n = open_heads.count()
        if not n:
            break
        if level > 1:  # the first levels leave most terms, later ones few
            notes = staged(below, "terms-below")
        longer = notes.filter(F.octet_length("term") >= width)
        below = longer.join(_sized(open_heads, n, most_broadcast), (F.col("lang") == F.col("_lang")) & (_head(width) == F.col("_head")), "left_semi")
        level, width = level + 1, width * 2
    kept = whole[0]
    for more in whole[1:]:
        kept = kept.unionByName(more)
    return kept


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + PRIOR) / (total + PRIOR kept)), in whole decimals."""
    above = (count + PRIOR).cast("decimal(18,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + PRIOR * kept).cast("decimal(18,0)")
    return F.call_function("div", above, below).cast("long") + 1


def pair_sums(shares: DataFrame, groups: DataFrame, cells: int = CELLS) -> DataFrame:
    """lang, g, h, value for g < h: absolute differences of shares summed over the kept terms that occur in any group.

    `shares` has lang, g, term, p for a group's own terms and `groups` has lang,
    g, p0 (the share of a term the group lacks), kept (the language's terms).
    """
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    chunks = sizes.select(F.col("lang").alias("_lang"), F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("kept") / F.greatest(F.lit(cells), F.col("n") * F.col("n")))).cast("int").alias("chunks"))
    dealt = shares.join(chunks, F.col("lang") == F.col("_lang")).withColumn("chunk", F.expr("pmod(xxhash64(term), chunks)").cast("int"))
    rows = groups.join(chunks, F.col("lang") == F.col("_lang")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def sums(own: pa.Table, all_groups: pa.Table) -> pa.Table:
        lang = all_groups["lang"][0]
        order = np.argsort(all_groups["g"].to_numpy())
        g, absent = all_groups["g"].to_numpy()[order], all_groups["p0"].to_numpy()[order]
        term = own["term"].combine_chunks().dictionary_encode()
        matrix = np.repeat(absent[:, None], len(term.dictionary), axis=1)
        matrix[np.searchsorted(g, own["g"].to_numpy()), term.indices.to_numpy()] = own["p"].to_numpy()
        parts = []
        for i in range(len(g) - 1):
            value = np.empty(len(g) - 1 - i, np.int64)
            for low in range(i + 1, len(g), 256):
                value[low - i - 1 : low - i + 255] = np.abs(matrix[low : low + 256] - matrix[i]).sum(axis=1)
            parts.append((np.full(len(value), g[i]), g[i + 1 :], value))
        columns = [np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64) for c in range(3)]
        return pa.table({"lang": pa.array([lang.as_py()] * len(columns[0]), pa.string()), "g": pa.array(columns[0], pa.int64()), "h": pa.array(columns[1], pa.int64()), "value": pa.array(columns[2], pa.int64())})

    left = dealt.select("lang", "chunk", F.col("g").cast("long").alias("g"), "term", "p").groupBy("lang", "chunk")
    right = rows.select("lang", "chunk", F.col("g").cast("long").alias("g"), "p0").groupBy("lang", "chunk")
    return left.cogroup(right).applyInArrow(sums, "lang string, g long, h long, value long").groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, least: int = LEAST, top: int = TOP, most_broadcast: int = MOST_BROADCAST, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs from the others.

    Part `pair` has each other source of the language with the distance of their
    shares over all kept terms; part `term` has the `top` kept terms a source
    uses more than its language does.  Null text, lang and source count as
    empty.  Each row is a document, also one that repeats another.  A language
    without kept terms has pairs of distance zero.  Other columns are not read;
    an empty table gives no rows.
    """
    notes = staged(term_notes(docs), "terms-notes")
    rows = notes.count()  # from the footers
    kept = _gathered(kept_terms(notes, least, most_broadcast), "terms-kept", rows)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    counts = _gathered(
        notes.join(_sized(kept, kept.count(), most_broadcast), ["lang", "term"], "left_semi")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n")),
        "terms-counts",
        rows,
    )
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = _gathered(
        notes.filter(F.col("term").isNull())
        .select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .fillna(0, ["total", "kept"])
        .withColumn("g", number)
        .withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(0).cast("long")),
        "terms-groups",
        rows,
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))

    measured = pair_sums(shares, groups, cells)
    name = groups.select("lang", "g", "source")
    pairs = (
        name.join(name.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), "lang")  # the report's own rows
        .filter(F.col("g") != F.col("h"))
        .withColumn("low", F.least("g", "h"))
        .withColumn("high", F.greatest("g", "h"))
        .join(measured.select("lang", F.col("g").alias("low"), F.col("h").alias("high"), "value"), ["lang", "low", "high"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    )
    order = [F.desc("value"), F.asc("item")]
    by_group = Window.partitionBy("lang", "source").orderBy(*order)
    pairs = pairs.withColumn("rank", F.row_number().over(by_group))

    lang_counts = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    lang_totals = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"))
    q = lang_counts.join(lang_totals, "lang").join(sizes, "lang").select("lang", "term", _share(F.col("n"), F.col("lang_total"), F.col("kept")).alias("q"))
    terms = (
        shares.join(q, ["lang", "term"])
        .filter(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_group))
        .filter(F.col("rank") <= top)
    )
    return pairs.unionByName(terms)
