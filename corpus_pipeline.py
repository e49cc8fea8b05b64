"""The corpus pipeline: from ``documents`` to a training mix, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; :func:`run` writes each as
Parquet into the shared folder and gives it, read again, to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontam, mixing, neardup, pii, quality
from textloom.llm.common import cut, free


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates that with the smallest id stays."""
    return neardup.keep(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontam.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are masked; no document goes."""
    return pii.keep(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Disclosing terms and components are no plain SQL; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table ``documents`` of ``sf_dir``. A stage's table goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        if before is not None:
            free(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
