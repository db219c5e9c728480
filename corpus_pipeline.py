"""A training-data pipeline over ``documents``: quality rules, near-duplicates, benchmark passages, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontaminate, mixing, near_dup, quality_rules, secret_scan
from llm.textops import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a risk-controlled cutoff reject go."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8)."""
    return near_dup.keep_one_of_each(docs, shingle=5, percent=80, band_rows=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    return secret_scan.mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to target weights: each document with the words that the mix takes of it."""
    return mixing.mix(docs)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("benchmark decontamination", benchmark),
          ("secret scans", secrets), ("mixing", mixture)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages; what a stage returns is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
