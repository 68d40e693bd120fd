"""A training corpus from `documents`, in five stages.

Each stage works on all that the one before kept, which is written as Parquet in
the shared folder and read again. All but the last return the columns of docs;
the last adds the rate and the copies of each document in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal.llm import decontam, langid, mixing, neardup, quality_rules
from caudal.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the model learns from these documents' own lang."""
    return langid.keep(docs, langid.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near a language reference."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    return neardup.keep(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.keep(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mixture, with rate and copies."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality),
    ("minhash_neardup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mixture),
]

#: Trained models and iterative fits have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
