"""A corpus pipeline over documents: each stage works on all rows its predecessor kept.

Defined cases are those of the operators: null and empty texts fail the quality rules and go; repeated
rows leave one; an empty table passes through as one; extra columns stay, and a column named like a
result of the last stage is replaced there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import bpe_codec, decontamination, quality_rules, secrets, simhash
from tillsight.llm.common import save, table
from tillsight.llm.queries import VOCABULARY


def recount(docs: DataFrame) -> DataFrame:
    """n_chars of texts that a stage may have changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's thresholds reject go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints link at three bits or fewer, as in the query of operator 5."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows go; so do documents that consist of them."""
    return recount(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark."""
    return recount(secrets.redact_secrets(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with its columns, and whether decoding the ids gives the text back."""
    return bpe_codec.encode_documents(docs, VOCABULARY, decoded=True)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", hide_secrets),
    ("bpe_encoding", encode),
]
# Sketches, fingerprints and token ids are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
