"""Pipeline stages: each takes (spark, docs, sf_dir) and applies one operator's decision to ``docs``.

All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replenix.llm import decontaminate, forest, mixing, quality, tokenfiles
from replenix.llm.common import shared_folder, table
from replenix.llm.queries import END_ID, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, once."""
    return forest.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a test item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix to the sources' target weights uses them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the documents, written in id order and read back: ids, places and checksums."""
    folder = shared_folder(spark, "token-files")
    tokenfiles.write(docs, folder, tokenizer_path("word_bpe_49k.json"), END_ID)
    return tokenfiles.digests(tokenfiles.read(spark, folder))
