"""The operators over whole tables: one query each, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierflow.llm import blocks, bpe, class_ngrams, host_rules, license_join, minhash, pii, prefix_trie, quality, suffix, tiling, wavelet, whitening
from courierflow.session import prepare, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def with_package(spark: SparkSession) -> SparkSession:
    """Tell Python workers where this package lies; on a cluster it is installed or sent along there."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return spark


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(with_package(prepare(spark)), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = pii.find(documents, pii.fit(documents)).select("doc_id", "spans")
    written = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS], F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"), (F.size("spans") > 0).alias("has_pii"))


@query
def op5_decontamination(spark, sf_dir):
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_licenses(spark, sf_dir):
    return license_join.scan(table(spark, sf_dir, "documents"))


@query
def op4_quality(spark, sf_dir):
    return quality.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op7_host_rules(spark, sf_dir):
    return host_rules.judge(table(spark, sf_dir, "documents"), "doc_id").drop("strict")


@query
def op8_wavelet(spark, sf_dir):
    folder = scratch(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return wavelet.documents_of(wavelet.read_shards(spark, folder), ids_crc32=F.crc32("ids"))


@query
def op10_blocks(spark, sf_dir):
    return blocks.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query
def op3_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("print")


@query
def op2_suffix(spark, sf_dir):
    return suffix.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op13_class_ngrams(spark, sf_dir):
    return class_ngrams.score_documents(table(spark, sf_dir, "documents")).drop("perplexity")
