"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    decontamination,
    exact_dedup,
    html_extraction,
    language,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    secrets,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)
from tallyhouse.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def _line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).drop("source")


def _html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extracted(pages, html_extraction.fit(pages))


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, table(spark, sf_dir, "pages"), language.fit(docs))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Query] = {
    "op1_line_dedup": _line_dedup,
    "op2_exact_dedup": _exact_dedup,
    "op3_toxicity": _toxicity,
    "op4_bagminhash": _near_dedup,
    "op5_mixing": _mixing,
    "op6_html_extraction": _html_extraction,
    "op7_warc": _warc,
    "op8_secrets": _secrets,
    "op9_language_id": _language,
    "op10_decontamination": _decontamination,
    "op11_lexical_search": _lexical_search,
    "op12_whitening": _whitening,
    "op13_substring_dedup": _substring_dedup,
}

#: A word and the twelve after it in one string; null where there are not so many.
_NEXT_WORDS = " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER later" for k in range(1, 13))])

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        WITH lowered AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), grouped AS (
            SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY t
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(t) AS text_sha256
        FROM lowered JOIN grouped USING (t)
    """,
    "op5_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents
        ), placed AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY turn, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
            FROM sized
        ), sizes AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
        ), weighed AS (
            SELECT source, source_size,
                   [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sizes
        ), ranked AS (
            SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS ratio FROM weighed
        ), levelled AS (
            SELECT *,
                   (CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS BIGINT)
                    - CAST(coalesce(sum(2 * source_size) OVER earlier, 0) AS BIGINT))
                   / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE)
                   AS level
            FROM ranked
            WINDOW earlier AS (ORDER BY ratio, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), goals AS (
            SELECT source, source_size,
                   least(CAST(2 * source_size AS DOUBLE),
                         max(CASE WHEN level <= ratio THEN level END) OVER () * weight) AS target
            FROM levelled
        ), cut AS (
            SELECT placed.*, source_size, target,
                   CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS passes,
                   CAST(floor(target) AS BIGINT) % greatest(source_size, 1) AS rest
            FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(passes * size + greatest(0, least(start + size, rest) - least(start, rest))
                    AS BIGINT) AS taken
        FROM cut
    """,
    "op7_warc": """
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM sized
            WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM sized LEFT JOIN firsts USING (payload_digest)
    """,
    "op11_lexical_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, doc_id, text FROM documents
        ), found AS (
            SELECT d, doc_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs
        ), held AS (
            SELECT d, doc_id, term, count(*) AS tf FROM found GROUP BY ALL
        ), lengths AS (
            SELECT d, count(*) AS n FROM found GROUP BY d
        ), totals AS (
            SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
        ), frequencies AS (
            SELECT term, count(*) AS df FROM held GROUP BY term
        ), asked AS (
            SELECT row_number() OVER () AS i, item_id, text FROM benchmark
        ), wanted AS (
            SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM asked
        ), weighed AS (
            SELECT i, item_id, term, CAST(floor(1000 * ln(
                       CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM wanted JOIN frequencies USING (term), totals
        ), scored AS (
            SELECT i, item_id, d, doc_id, CAST(sum(w * (1000000000 * tf
                       // (1000 * tf + 20 * (50 + 50 * n * docs // terms)))) AS BIGINT) AS score
            FROM weighed JOIN held USING (term) JOIN lengths USING (d), totals
            GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY i, item_id ORDER BY score DESC, doc_id NULLS LAST)
        QUALIFY row_number() OVER best <= 50
    """,
    "op13_substring_dedup": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), placed AS (
            SELECT d, doc_id, unnest(words) AS word,
                   unnest(generate_series(1, len(words))) AS place
            FROM docs
        ), windows AS (
            SELECT d, doc_id, place, {_NEXT_WORDS} AS words
            FROM placed WINDOW later AS (PARTITION BY d ORDER BY place)
        ), firsts AS (
            SELECT words, min(doc_id) AS first_id FROM windows
            WHERE words IS NOT NULL GROUP BY words
        ), gone AS (
            SELECT DISTINCT d, unnest(generate_series(place, place + 12)) AS place
            FROM windows JOIN firsts USING (words) WHERE first_id < doc_id
        ), kept AS (
            SELECT d, string_agg(word, ' ' ORDER BY place) AS text
            FROM placed ANTI JOIN gone USING (d, place) GROUP BY d
        ), removed AS (
            SELECT d, count(*) AS n FROM gone GROUP BY d
        )
        SELECT doc_id, len(words) AS n_words, coalesce(removed.n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (d) LEFT JOIN removed USING (d)
    """,
}
