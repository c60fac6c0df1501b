"""Small frames for the corpus operators."""

from __future__ import annotations

from zlib import crc32

DOCS = "doc_id long, text string, lang string, source string, n_chars int"

CLASHES = ["_id", "__id", "_sha", "__sha", "_own_sha", "_key", "__key", "_marks", "__text"]


def docs_frame(spark, rows, partitions=3):
    """Rows of (doc_id, text) or longer as a frame with the columns of documents and two that clash with inner names."""
    full = [(*r, *("en", "src0", len(r[1] or ""))[len(r) - 2 :]) for r in rows]
    frame = spark.createDataFrame(full, DOCS).repartition(partitions)
    return frame.selectExpr("*", "cast(null as string) as key", "'x' as fp", "1 as row", "2 as position", "'t' as __other", *[f"'c' as `{c}`" for c in CLASHES])


def by_id(frame, *columns):
    rows = frame.select("doc_id", *columns).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0], str(r[1:])))


def remainder(doc_id, n):
    return crc32(str(doc_id).encode() if doc_id is not None else b"") % n


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
