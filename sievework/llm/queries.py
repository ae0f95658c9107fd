"""Queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, line_dedup, ngram_join, packing, pii, quality, search, sharding, warc, wrappers
from .base import table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.search(docs, docs.where("doc_id % 50 = 0"))


def op2_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op5_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op8_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flag_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk_search,
        op2_html_wrappers,
        op3_hilbert_shards,
        op4_line_dedup,
        op5_mixture_packing,
        op6_warc_dictionary,
        op7_pii_tagger,
        op8_cotrained_quality,
        op9_ngram_join,
        op10_template_decontamination,
    )
}

#: WARC round trip: sizes, digests and which record answers which follow from the payloads alone.
_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT h, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, n AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN top IS NOT NULL AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN m ON p.h = m.h AND p.n >= 1000
"""

ORACLES: dict[str, str] = {
    "op1_topk_search": search.ORACLE,
    "op6_warc_dictionary": _WARC,
    "op10_template_decontamination": decontaminate.ORACLE,
}
