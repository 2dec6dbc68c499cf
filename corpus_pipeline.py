"""Corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, contaminated documents go, secrets are masked, and sources are
mixed to their target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and reads again as the next one's docs.
All stages but the last return the columns of documents; the last returns a
row per copy that the mixture takes, with the copy's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontaminate, mixing, near_dedup, secrets_scan, toxicity
from rollcall.llm.common import stash, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxicity is below the limit."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets_scan.mask(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
]

# A fitted model and rounding by error diffusion aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
