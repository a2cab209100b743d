"""The corpus pipeline: documents that are good, once each, free of test items, and with a rate to be drawn at.

Each stage works on all rows that the stage before it kept, as written and read back. All stages but the last return the
columns of documents; the last adds ``mix_rate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airscan.llm import compression, decontaminate, mixing, set_join, stream_dedup
from airscan.llm.frames import table
from airscan.sources.local import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return compression.accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return stream_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar shingle sets."""
    return set_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are drawn at all, with their rates."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mix),
]

#: SQL has no dictionaries, streams or fitted rates; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
