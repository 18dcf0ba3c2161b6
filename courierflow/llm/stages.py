"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns what it keeps of docs.

All but the last return the columns of ``documents``. Null texts count as empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierflow.llm import bpe, minhash, pii, quality, tiling
from courierflow.llm.queries import table, with_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking model doesn't reject."""
    return quality.accepted(docs, table(with_package(spark), sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    with_package(spark)
    return minhash.survivors(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item, in whatever order."""
    return tiling.clean(docs, table(with_package(spark), sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows."""
    with_package(spark)
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and whether they decode to the text."""
    with_package(spark)
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    same = (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes")
    return coded.select("doc_id", "lang", "source", "n_chars", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same)
