"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import bpe_codec, chat, decontamination, langid, quality_classifier, quality_rules, reference_sql, secrets, simhash, substring_dedup, token_counts, url_filter, vector_codes, whitening
from tillsight.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, folder, "documents"))


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.encode_digests(table(spark, folder, "documents"), VOCABULARY, keep=["doc_id"])


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"), keep=["doc_id"])


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), VOCABULARY, keep=["doc_id"])


def simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def substring_dedup_words(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_substrings(table(spark, folder, "documents"), texts=False)


def benchmark_hits(spark: SparkSession, folder: str) -> DataFrame:
    marked = decontamination.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def chat_digests(spark: SparkSession, folder: str) -> DataFrame:
    return chat.conversation_digests(table(spark, folder, "conversations"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.language_verdicts(table(spark, folder, "documents"))


def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, folder, "pages"))


def compressed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))


def passage_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_adaptive_quality": adaptive_quality,
        "op2_bpe_round_trip": bpe_round_trip,
        "op3_secret_scan": secret_scan,
        "op4_token_count": token_count,
        "op5_simhash_near_dedup": simhash_near_duplicates,
        "op6_substring_dedup": substring_dedup_words,
        "op7_benchmark_decontamination": benchmark_hits,
        "op8_chat_formatting": chat_digests,
        "op9_language_id": language_id,
        "op10_url_filters": url_filters,
        "op11_vector_codes": compressed_vectors,
        "op12_quality_classifier": passage_quality,
        "op13_embedding_whitening": whitened_embeddings,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_adaptive_quality": reference_sql.quality_sql(),
        "op6_substring_dedup": reference_sql.substrings_sql(),
        "op7_benchmark_decontamination": reference_sql.benchmark_sql(),
        "op8_chat_formatting": chat.digests_sql(),
        "op11_vector_codes": vector_codes.codes_sql(),
    }
