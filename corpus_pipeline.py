"""The corpus pipeline: stages, each a function of (spark, docs, sf_dir), run one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courierflow.llm import stages
from courierflow.session import materialize, prepare

STAGES = [
    ("quality", stages.quality_stage),
    ("near_duplicates", stages.near_duplicate_stage),
    ("decontamination", stages.decontamination_stage),
    ("personal_data", stages.personal_data_stage),
    ("bpe", stages.bpe_stage),
]

# The quality model is fitted and merges are ranked by steps that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
