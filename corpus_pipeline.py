"""The corpus pipeline: five stages over ``documents``, each one an operator of
``tessera.llm`` at its production settings.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``. A stage's result is written as Parquet and read again, so a lost
executor never replays earlier stages. The first and last stages are not
expressible in SQL, so there is no ORACLE_SQL; tests/llm holds the stages
against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import lines, minhash, segmentation, suffixes, toxicity
from tessera.llm.common import table, written


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the first; n_chars follows."""
    return lines.dedup_documents(docs)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.drop_near_duplicates(docs)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return suffixes.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def stage_segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document that is left."""
    return segmentation.sampled(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_lines),
    ("minhash_dedup", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("segmentation", stage_segmentation),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
