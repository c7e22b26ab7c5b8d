"""The corpus pipeline: quality, exact dedup, near dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame; ``run`` writes each stage's rows as a Parquet table in the shared
checkpoint folder and hands the next stage the reread table, so a lost executor
never repeats an earlier stage. All stages but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.llm import exact_dedup, near_dedup, packing, quality, secrets
from pricegrid.llm.words import small_batches
from pricegrid.session import cut_lineage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. It learns from the
    labels of the documents at hand."""
    small_batches(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (white space apart) the one with the smallest id."""
    small_batches(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on five-word shingles, the document
    with the smallest id."""
    small_batches(spark)
    return near_dedup.deduplicate(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and ``n_chars`` brought up to date."""
    small_batches(spark)
    masked = secrets.redact(docs, secrets.fit(docs))
    chars = F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    return masked.withColumn("n_chars", chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence of 1024 tokens."""
    small_batches(spark)
    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          special=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: A trained classifier, corpus-fitted thresholds and tokens can't be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
