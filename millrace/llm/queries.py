"""Queries of this subpackage over the driver's tables, by name; SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import sql
from millrace.llm.bpe import encode_documents
from millrace.llm.centroids import cluster_vectors
from millrace.llm.common import documents
from millrace.llm.extraction import extract
from millrace.llm.langid import identify
from millrace.llm.media import media_column
from millrace.llm.mixing import mix_sources
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.quality import quality
from millrace.llm.secrets import scan_secrets
from millrace.llm.spelling import spelling_variants
from millrace.llm.substring_dedup import remove_earlier_windows
from millrace.llm.suffix_dedup import remove_repeats
from millrace.llm.toxicity import toxicity


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_column(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "n_verified_links")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier_windows(documents(spark, sf_dir))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_byte_bpe, op3_language_id, op4_media_columns, op5_toxicity, op6_source_mix, op7_order_minhash, op8_substring_dedup, op9_secret_scan, op10_quality_rules, op11_html_extraction, op12_spelling_variants, op13_centroid_clusters)
}
ORACLE_SQL: dict[str, str] = {
    "op12_spelling_variants": sql.SPELLING,
    "op13_centroid_clusters": sql.CENTROIDS,
    "op8_substring_dedup": r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM texts)
), later AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
), words AS (
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM texts
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS line FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
""",
}
