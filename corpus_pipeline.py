"""Corpus pipeline over ``documents``: quality rules, near-dedup, decontamination, mixing, token files.

``run(spark, sf_dir)`` applies the stages in order; every stage is written as Parquet to the shared folder and
reread as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from replenix.llm import stages
from replenix.llm.common import stored, table

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("source_mix", stages.source_mix),
    ("token_files", stages.token_files),
]

# Token ids and near-duplicate groups are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
