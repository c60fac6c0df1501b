"""The registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardry.llm import decontaminate, divergence, exact_dedup, hilbert, lm, multi_index, phrases
from hazardry.llm import pieces, quality, sanitise, simhash, toxicity, warc
from hazardry.sources.workspace import fresh_folder

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """Ids of every document and whether they decode to its text again."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model).select("doc_id", "n_tokens", "token_ids", "round_trip")


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.page_records(warc.read_archives(spark, folder, payload=False))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(_table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(_table(spark, sf_dir, "documents")).drop("marks")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.text_scores(_table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": decontamination,
    "op2_sentencepiece": sentencepiece,
    "op3_warc": warc_round_trip,
    "op4_toxicity": toxic,
    "op5_hilbert_sharding": hilbert_sharding,
    "op6_personal_data": personal_data,
    "op7_exact_dedup": exact_duplicates,
    "op8_lm_scoring": lm_scores,
    "op9_simhash": near_duplicates,
    "op10_quality": quality_scores,
    "op11_source_divergence": source_divergence,
    "op12_collocations": collocations,
    "op13_nearest_vectors": nearest_vectors,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

TWINS = {
    "op1_decontamination": f"""
        WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, size, list_slice(w, i, i + size - 1) AS span
            FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                  FROM item WHERE len(w) > 0)),
        doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT size FROM windows),
        grams AS (
            SELECT r, size, i, list_slice(w, i, i + size - 1) AS span
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
        hits AS (SELECT g.r, g.i, g.size, w.item_id FROM grams g JOIN windows w ON g.size = w.size AND g.span = w.span),
        words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op3_warc": """
        WITH page AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        first AS (
            SELECT payload_digest, min(page_id) AS first_id FROM page WHERE payload_bytes >= 100
            GROUP BY payload_digest HAVING count(*) > 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM page LEFT JOIN first USING (payload_digest)""",
    "op7_exact_dedup": f"""
        WITH doc AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM doc WINDOW g AS (PARTITION BY t)""",
    "op11_source_divergence": f"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({_LOWER}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
            FROM documents),
        occurs AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM doc) GROUP BY ALL),
        kept AS (SELECT lang, term FROM occurs GROUP BY ALL HAVING count(*) >= 30),
        size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        counts AS (SELECT lang, source, term, sum(n) AS n FROM occurs SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM doc),
        totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
        shares AS (
            SELECT lang, t.source, term, coalesce(n, 0) AS n,
                   CAST(1 + (CAST(1000000000 AS HUGEINT) * CAST(coalesce(n, 0) + 5 AS HUGEINT)) // CAST(total + 5 * v AS HUGEINT) AS BIGINT) AS p
            FROM totals t JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN counts c USING (lang, source, term)),
        sums AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
        whole AS (
            SELECT lang, term,
                   CAST(1 + (CAST(1000000000 AS HUGEINT) * CAST(n + 5 AS HUGEINT))
                        // CAST(sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang) AS HUGEINT) AS BIGINT) AS q
            FROM sums),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
        WHERE part = 'pair' OR rank <= 50""",
    "op12_collocations": f"""
        WITH piece AS (
            SELECT lang, regexp_extract_all(p, '[^ \\t]+') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
        counts AS MATERIALIZED (
            SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM piece, (VALUES (1), (2), (3)) s(m) WHERE len(w) >= m)
            GROUP BY ALL HAVING count(*) >= 10),
        total AS (SELECT lang, sum(len(w)) AS n FROM piece GROUP BY lang),
        long AS MATERIALIZED (SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
        longer AS (
            SELECT lang, phrase, max(f) AS f
            FROM (SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM long WHERE m = 3) GROUP BY ALL),
        cuts AS MATERIALIZED (
            SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail
            FROM (SELECT *, unnest(range(1, m)) AS k FROM long)),
        scored AS (
            SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
                   CAST(CAST(1000000 AS HUGEINT) * CAST(a AS HUGEINT) * CAST(a AS HUGEINT) // (CAST(x.f AS HUGEINT) * CAST(y.f AS HUGEINT)) AS BIGINT) AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
            JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
            LEFT JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase
            WHERE o.f IS NULL OR 100 * o.f < 50 * a),
        worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
