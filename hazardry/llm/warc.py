"""WARC archives: written and read back as Spark text files with separators of their own.

Writing.  A record is one value whose separator, two line ends, is the end mark
that the format asks for.  Payloads are copied byte by byte.  Of records with
equal payload digests the smallest page_id holds the payload, the others are
revisits that refer to it.

Reading.  Archives are split at any byte.  The text source with the version
line as its separator gives, for every split, the pieces between two version
lines, each a candidate record; their lengths add up to exact offsets.  A
candidate's header names its successor.  A payload may hold the version line
too, so:

1. inside a split, consecutive candidates that name each other form a run;
2. a run's last successor is an entry into another run, an edge of a small graph;
3. pointer jumping from offset 0 of each file doubles the reach of every edge
   until no new entry is found, in log2(splits) rounds;
4. candidates of a reached run at or after its entry are records.  The pieces
   in between belong to the payload before them and are joined to it again.

Only places, lengths and header fields take part in this.  What is unreachable is rejected.  A chain that breaks ends its file there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardry.sources.workspace import staged

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_REVISIT = 100
MOST_BROADCAST_ROWS = 500_000
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", least: int = LEAST_REVISIT) -> None:
    """A record per row of page_id, url, html; other columns are not read.

    A null html is an empty payload, a null url has no target line, a null
    page_id an empty one in the record's id; it is never the smallest.  Rows
    that tie on the smallest page_id of their payload are all responses.
    Payloads under `least` bytes are always responses.  An empty table writes
    no records.

    Payloads that occur more than once, a digest and an id each, are counted;
    up to MOST_BROADCAST_ROWS of them are broadcast and pages are not shuffled,
    beyond that pages are joined to them by digest.
    """
    size = F.octet_length("payload")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn(
        "digest", F.unhex(F.sha2("payload", 256))
    )
    first = staged(
        rows.filter(size >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("first_digest"), "first_id"),
        "warc-first",
    )
    if first.count() <= MOST_BROADCAST_ROWS:
        first = F.broadcast(first)
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit(HTTP_HEAD), size.cast("string"), F.lit(END))
    block = F.when(revisits, http).otherwise(F.concat(http, F.col("payload")))
    content = F.octet_length(http) + F.when(revisits, 0).otherwise(size)

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(revisits, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\\r\\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.lower(F.hex("digest"))),
        F.concat(F.lit("WARC-Payload-Length: "), size.cast("string")),
        F.when(revisits, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisits, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first_id")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), content.cast("string")),
    )
    (
        rows.join(first, F.col("digest") == F.col("first_digest"), "left")
        .select(F.concat(F.lit(VERSION), lines, F.lit(END), block).alias("value"))
        .write.option("lineSep", END)
        .text(path)
    )


def _field(name: str, value: str = "[^\\r\\n]*?") -> Column:
    return F.regexp_extract("head", f"(?im)^{name}:[ \\t]*({value})[ \\t]*$", 1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two version lines, in the order of each split."""
    return (
        spark.read.option("lineSep", VERSION)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
        .withColumn("serial", F.monotonically_increasing_id())
        .withColumn("bytes", F.octet_length("value").cast("long"))
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece without its text: place, length, header fields and the successor's distance.

    `whole` says that the piece holds its record from header to end mark; the
    digest and length of its payload are taken here, where the text is.
    """
    content = _field("Content-Length", "[0-9]+")
    pieces = (
        _pieces(spark, path)
        .withColumn("head", F.when(F.instr("value", END) > 0, F.substring_index("value", END, 1)))
        .withColumn("content", F.when(content != "", content).try_cast("long"))
        .withColumn("head_bytes", (F.octet_length("head") + len(END)).cast("long"))
    )
    reach = F.col("head_bytes") + F.col("content") + len(END)
    return staged(
        pieces.withColumn("whole", F.coalesce(reach == F.col("bytes"), F.lit(False))).select(
            "file",
            "split",
            "serial",
            "bytes",
            "content",
            "head_bytes",
            (reach + len(VERSION)).alias("distance"),
            "whole",
            *[_field(f).alias(c) for f, c in _FIELDS.items()],
            F.when(F.col("whole"), F.sha2(_payload(F.col("value")), 256)).alias("digest"),
            F.when(F.col("whole"), F.octet_length(_payload(F.col("value")))).cast("long").alias("length"),
        ),
        "warc-pieces",
    )


_FIELDS = {
    "WARC-Type": "record_type",
    "WARC-Record-ID": "record_id",
    "WARC-Target-URI": "url",
    "WARC-Refers-To": "refers_to",
    "WARC-Payload-Digest": "header_digest",
    "WARC-Payload-Length": "header_length",
}


def _payload(piece: Column) -> Column:
    """Bytes after the HTTP header and before the end mark, of a piece that holds a whole record."""
    start = F.octet_length(F.substring_index(piece, END, 2)) + len(END)
    return F.substring(piece.cast("binary"), start + 1, F.greatest(F.octet_length(piece) - start - len(END), F.lit(0)))


def located(pieces: DataFrame) -> DataFrame:
    """Adds `start`, the byte at which each candidate's version line begins, null for what stands before the first."""
    mark = len(VERSION)
    inside = Window.partitionBy("file", "split").orderBy("serial").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("file", "split").agg(F.sum(F.col("bytes") + mark).alias("span"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("file", "split", F.coalesce(F.sum("span").over(before), F.lit(0)).alias("base"))
    start = F.col("base") + F.coalesce(F.sum(F.col("bytes") + mark).over(inside), F.lit(0)) - mark
    return pieces.join(bases, ["file", "split"]).withColumn("at", start).withColumn(
        "start", F.when(F.col("at") >= 0, F.col("at"))
    )


def _reached(nodes: DataFrame) -> DataFrame:
    """Of nodes (file, entry, jump) those reachable from entry 0, by doubling every jump each round."""
    found = nodes.filter("entry = 0").select("file", "entry")
    jumps = nodes
    n = found.count()
    while True:
        further = found.join(jumps, ["file", "entry"]).filter("jump is not null").select("file", F.col("jump").alias("entry"))
        found = staged(found.unionByName(further).distinct(), "warc-reach")
        if (now := found.count()) == n:
            return found
        n = now
        after = jumps.select("file", F.col("entry").alias("jump"), F.col("jump").alias("next"))
        jumps = staged(
            jumps.join(after, ["file", "jump"], "left").select("file", "entry", F.col("next").alias("jump")), "warc-jumps"
        )


def verified(pieces: DataFrame) -> DataFrame:
    """Pieces with `record`, the start of the record they belong to (null before the first and after a break)."""
    order = Window.partitionBy("file", "split").orderBy("serial")
    marked = F.col("start").isNotNull() & F.col("distance").isNotNull()
    placed = staged(
        located(pieces)
        .withColumn("next", F.when(marked, F.col("start") + F.col("distance")))
        .withColumn("_breaks", F.coalesce(F.lag("next").over(order) != F.col("start"), F.lit(True)).cast("int"))
        .withColumn("run", F.sum("_breaks").over(order))
        .drop("_breaks"),
        "warc-placed",
    )
    runs = (
        placed.filter(marked)
        .groupBy("file", "split", "run")
        .agg(F.max("next").alias("exit"), F.min("start").alias("head"))
    )
    heads = placed.filter(marked).select("file", "split", "run", F.col("start").alias("entry"))
    entries = heads.join(runs.select("file", F.col("exit").alias("entry")).distinct(), ["file", "entry"]).unionByName(
        heads.filter("entry = 0")
    ).distinct()
    nodes = staged(
        entries.join(runs.select("file", "split", "run", F.col("exit").alias("jump")), ["file", "split", "run"]), "warc-nodes"
    )
    live = nodes.select("file", F.col("entry").alias("jump")).withColumn("_hit", F.lit(True))
    linked = nodes.join(live, ["file", "jump"], "left").select("file", "entry", F.when(F.col("_hit"), F.col("jump")).alias("jump"))
    kept = _reached(linked).join(nodes.select("file", "entry", "split", "run"), ["file", "entry"])
    real = F.when(marked & (F.col("start") >= F.col("entry")), F.col("start"))
    told = placed.join(kept, ["file", "split", "run"], "left").withColumn("real", real)
    lasts = told.groupBy("file", "split").agg(F.max("real").alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("file", "split", F.max("last").over(before).alias("carry"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return told.join(carried, ["file", "split"]).withColumn(
        "record", F.coalesce(F.max("real").over(upto), F.col("carry"))
    )


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records reachable from the start of each file.

    file, start, content (bytes of the block), record_type, record_id, url,
    refers_to, header_digest, header_length, digest and length of the payload
    as read, truncated, and the payload itself if asked for.  A record whose
    payload holds version lines is put together from its pieces, so memory is
    that of the largest record.  No records give no rows.
    """
    told = staged(verified(candidates(spark, path)), "warc-records")
    fields = ["file", "start", "content", *_FIELDS.values()]
    records = told.filter("real is not null")
    whole = records.filter("whole").select(*fields, "digest", "length", F.lit(False).alias("truncated"))
    wanted = records if payload else records.filter("not whole")
    if not payload and wanted.isEmpty():
        return whole
    parts = told.select("file", "at", "record").join(
        wanted.select("file", F.col("start").alias("record")), ["file", "record"], "left_semi"
    )
    texts = _pieces(spark, path).join(wanted.select("file").distinct(), "file", "left_semi")
    bodies = (
        located(texts)
        .select("file", "at", "value")
        .join(parts, ["file", "at"])
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
        .select("file", F.col("record").alias("start"), F.array_join(F.col("parts.value"), VERSION).alias("value"))
    )
    reach = F.col("head_bytes") + F.col("content") + len(END)
    mended = (
        wanted.select(*fields, "head_bytes")
        .join(bodies, ["file", "start"])
        .withColumn("truncated", F.octet_length("value") < reach)
        .withColumn("payload", _payload(F.substring(F.col("value").cast("binary"), F.lit(1), reach.cast("int")).cast("string")))
        .select(*fields, F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("length"), "truncated", "payload")
    )
    return mended if payload else whole.unionByName(mended.drop("payload"))


def page_records(records: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit has no payload of its own, so the size and digest of the payload
    it stands for come from its header.
    """
    revisit = F.col("record_type") == "revisit"
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as long)")
    return records.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.expr("try_cast(header_length as long)")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("header_digest", ":", -1)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
