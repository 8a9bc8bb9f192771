"""The queries of this folder, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gustmill.llm import (
    bpe,
    cross_tokenizers,
    decontamination,
    edit_fingerprints,
    hmm_lm,
    html_pages,
    language_id,
    minhash,
    secrets,
    token_counts,
    token_files,
    url_filters,
    whitening,
)
from gustmill.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints.with_classes(table(spark, sf_dir, "documents"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.scores(table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judged_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_bound")


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked_components(table(spark, sf_dir, "documents"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_pages.extracted(table(spark, sf_dir, "pages"), joint="\n\n")


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_of(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizers.alignment_digests(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": _op1,
        "op2_secrets": _op2,
        "op3_fingerprints": _op3,
        "op4_lm_scores": _op4,
        "op5_url_filters": _op5,
        "op6_near_dedup": _op6,
        "op7_html_text": _op7,
        "op8_decontamination": _op8,
        "op9_token_counts": _op9,
        "op10_language_id": _op10,
        "op11_whitening": _op11,
        "op12_token_files": _op12,
        "op13_alignment": _op13,
    }


_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

_DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (
  SELECT item_id, w, least(13, len(w)) AS size
  FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[j:j + size - 1], ' ') AS line
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS j FROM items)
),
places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM docs, (SELECT DISTINCT size FROM items) WHERE len(w) >= size
),
found AS (
  SELECT doc_id, item_id, i, p.size
  FROM (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS line FROM places) p
  JOIN item_windows USING (size, line)
),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op8_decontamination": _DECONTAMINATION}
