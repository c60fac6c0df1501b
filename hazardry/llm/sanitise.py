"""Personal data, and the terms that give it away.

Four kinds are found by pattern: email, ip, card and phone.  Each found value is
a protected entity.  A term is a word of three letters or more outside all found
values.  Any term of a text that holds an entity may reveal it, near or far; how
strongly, the corpus tells.  Of N distinct texts, `of` hold the entity, `n` the
term and `both` both.  The term then discloses

    log2( (both * N / n + PRIOR) / (of + PRIOR) )      bits about the entity:

the pointwise mutual information, with the share of the entity's texts that hold
the term drawn towards its share of all texts, as if PRIOR more texts had been
seen, so that entities of one or two texts are judged as well.  The entity itself
is worth log2(N / of) bits.  A term that discloses GENERALISE of them or more is
generalised wherever it stands in the entity's texts, from REMOVE on it is
removed.  An entity that all texts hold is no secret.

Counts cover every text; equal texts count once.  Entities travel as 128-bit
hashes.  Entities that stand in the same texts disclose alike and are one class,
so a list of addresses meets its terms once, not once per address.  Pairs whose
bits can't reach the bound, given `of` and `n`, are not counted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardry.llm.common import free_names, text_or_empty
from hazardry.sources.workspace import staged

KINDS = ("email", "ip", "card", "phone")
PRIOR = 1.0
GENERALISE, REMOVE = 0.7, 0.85
COUNTER_SIZE = 400_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_NO_DIGIT = re.compile(r"[^0-9]")

KEY = ["key1", "key2"]
CLASS = ["of", "set1", "set2"]

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; looks back from each @, so no stretch is read twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            free = match.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the four kinds in code points, by kind, then start."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return spans


def terms_outside(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """(term, start, end) of the terms that touch no span."""
    taken = sorted((a, b) for _, a, b in spans)
    out, at, reach = [], 0, 0
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if m.start() >= reach:
            out.append((m.group().lower(), *m.span()))
    return out


def text_keys() -> list[Column]:
    """128 bits that stand for a text; null counts as empty."""
    text = text_or_empty()
    return [F.xxhash64(text).alias("key1"), F.xxhash64(F.lit(1), text).alias("key2")]


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts with spans, entities and, if there are any, terms; and in how many texts each term stands."""
    schema = (
        "key1 long, key2 long, spans array<struct<kind: string, start: int, end: int>>, entities array<binary>, "
        "terms array<struct<term: string, start: int, end: int>>, term string, n long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = [("start", pa.int32()), ("end", pa.int32())]
        types = [
            pa.int64(),
            pa.int64(),
            pa.list_(pa.struct([("kind", pa.string()), *place])),
            pa.list_(pa.binary()),
            pa.list_(pa.struct([("term", pa.string()), *place])),
            pa.string(),
            pa.int64(),
        ]
        names = [*KEY, "spans", "entities", "terms", "term", "n"]

        def rows(size: int, **columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * size), t) for c, t in zip(names, types)], names=names)

        counts: Counter = Counter()
        for batch in batches:
            spans, entities, terms = [], [], []
            for text in batch.column("text").to_pylist():
                own = base_spans(text)
                words = terms_outside(text, own) if own else []
                counts.update({w[0] for w in words} if own else {w.lower() for w in set(_TERM.findall(text))})
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                entities.append(list({xxhash.xxh3_128_digest(f"{k}:{text[a:b].lower()}") for k, a, b in own}))
                terms.append([dict(zip(("term", "start", "end"), w)) for w in words])
                if len(counts) > COUNTER_SIZE:
                    yield rows(len(counts), term=list(counts), n=list(counts.values()))
                    counts = Counter()
            key1, key2 = (batch.column(c).to_pylist() for c in KEY)
            yield rows(batch.num_rows, key1=key1, key2=key2, spans=spans, entities=entities, terms=terms)
        yield rows(len(counts), term=list(counts), n=list(counts.values()))

    texts = docs.select(text_or_empty().alias("text")).distinct().select("text", *text_keys())
    both = staged(texts.mapInArrow(run, schema), "sanitise-found")
    counts = both.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("n"))
    return both.filter(F.col("key1").isNotNull()).select(*KEY, "spans", "entities", "terms"), counts


def disclosed(both: Column, of: Column, n: Column, total: int) -> Column:
    """The share of an entity's information that a term discloses; null if all texts hold the entity."""
    every = F.lit(float(total))
    return F.when(of < total, F.log2((both * every / n + PRIOR) / (of + PRIOR)) / F.log2(every / of))


def disclosure(found: DataFrame, counts: DataFrame, generalise: float = GENERALISE) -> DataFrame:
    """key1, key2, term, share: the terms of each text that disclose one of its entities, with the largest share."""
    total = found.count()
    held = found.filter(F.size("entities") > 0)
    entities = held.select(*KEY, F.explode("entities").alias("entity"))
    sets = entities.groupBy("entity").agg(
        F.count(F.lit(1)).alias("of"), F.bit_xor("key1").alias("set1"), F.bit_xor("key2").alias("set2")
    )
    classes = entities.join(sets, "entity").select(*KEY, *CLASS).distinct()
    terms = held.select(*KEY, F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term"))
    at_most = disclosed(F.least("of", "n"), F.col("of"), F.col("n"), total)
    pairs = staged(terms.join(counts, "term").join(classes, KEY).filter(at_most >= generalise), "sanitise-pairs")
    share = disclosed(F.col("both"), F.col("of"), F.col("n"), total)
    telling = (
        pairs.groupBy("term", "n", *CLASS)
        .agg(F.count(F.lit(1)).alias("both"))
        .select("term", *CLASS, share.alias("share"))
        .filter(F.col("share") >= generalise)
    )
    return pairs.drop("n").join(telling, ["term", *CLASS]).groupBy(*KEY, "term").agg(F.max("share").alias("share"))


def _marked(docs: DataFrame, generalise: float, remove: float) -> DataFrame:
    """key1, key2 and marks of each distinct text: its spans, then terms to generalise, then those to remove."""
    found, counts = _found(docs)
    more = (
        found.select(*KEY, F.explode("terms").alias("t"))
        .select(*KEY, "t.*")
        .join(disclosure(found, counts, generalise), [*KEY, "term"])
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_list(F.struct((F.col("share") >= remove).alias("gone"), "start", "end"))).alias("more"))
    )
    kind = lambda s: F.when(s["gone"], "gone").otherwise("term").alias("kind")
    later = F.transform("more", lambda s: F.struct(kind(s), s["start"].alias("start"), s["end"].alias("end")))
    return found.select(*KEY, "spans").join(more, KEY, "left").select(
        *KEY, "spans", F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", later)).alias("marks")
    )


def personal_data(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per document: doc_id, counts per kind, base_sha256, spans, and `marks`, the same as a list.

    Terms are listed in spans as kind `term` (generalised) or `gone` (removed),
    after the four kinds.  Null counts as empty and has no spans.  Repeated rows
    each give a row; equal texts have equal marks.  An empty table gives no rows.
    Other columns are not read.
    """
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    of_text = _marked(docs, generalise, remove).select(
        *KEY,
        *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform("spans", told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("marks", told), ",").alias("spans"),
        "marks",
    )
    return docs.select("doc_id", *text_keys()).join(of_text, KEY).drop(*KEY)


def redacted(text: str, marks: list[Span]) -> str:
    """Personal data by its kind in brackets, generalised terms by [term], removed ones by nothing; the first of overlapping spans wins."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in marks):
        if start >= at:
            out += [text[at:start], "" if kind == "gone" else f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """All rows and columns of docs with the text sanitised; null stays null."""
    own = free_names(docs, "_key1", "_key2", "_marks")
    marks = _marked(docs, generalise, remove).select(*[F.col(c).alias(o) for c, o in zip([*KEY, "marks"], own)])
    first, second = text_keys()
    both = docs.join(marks, (first == F.col(own[0])) & (second == F.col(own[1])), "left")

    @F.udf("string", useArrow=True)
    def clean(text, spans):
        return None if text is None else redacted(text, [(s["kind"], s["start"], s["end"]) for s in spans or ()])

    return both.withColumn("text", clean("text", own[2])).select(*docs.columns)
