"""Registered queries of the subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstar.llm import collocations, decontaminate, exact_dedup, language_model, license_scan, line_dedup, mixing, near_dedup, quality, repeat_removal, shingle_join, token_counts, vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeat_removal.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "group_id", "group_size", "kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


#: Shares of tokens that the mixed corpus aims at.
TARGETS = {"clean": 0.90, "toxic": 0.05, "low": 0.05}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.mix(docs, _table(spark, sf_dir, "labels"), TARGETS).select("doc_id", "mix.*")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_held_out(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join_report(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_repeat_removal": op3_repeat_removal,
    "op4_near_dedup": op4_near_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_language_model": op8_language_model,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_shingle_join": op12_shingle_join,
    "op13_vector_codes": op13_vector_codes,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op5_license_scan": license_scan.scan_sql(),
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_decontamination": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words, least(len({_WORDS}), 13) AS n FROM benchmark),
        bw AS (SELECT DISTINCT item, n, list_slice(words, i, i + n - 1) AS win
               FROM (SELECT item, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM b WHERE n > 0)),
        dw AS (SELECT doc_id, i, n, list_slice(words, i, i + n - 1) AS win
               FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
                     FROM d, (SELECT DISTINCT n FROM bw) WHERE len(words) >= n)),
        hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.win = bw.win),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_collocations": collocations.collocations_sql(),
    "op12_shingle_join": shingle_join.join_sql(),
    "op13_vector_codes": vector_codes.compress_sql(),
}
