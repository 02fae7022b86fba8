"""The training-data pipeline over documents: one operator per stage, each result written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepulse.llm import language_id, line_dedup, near_duplicates, packing, quality_rules
from zonepulse.sources.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language_id.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur across documents go, except in the first of them."""
    return line_dedup.clean_documents(docs, line_dedup.WHOLE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_duplicates.filter_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents in full sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("language_id", languages),
    ("line_dedup", lines),
    ("near_duplicates", near_copies),
    ("packing", sequences),
]

#: Language models, signatures and tokenizers cannot be stated in SQL; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, last = STAGES
    for name, stage in before:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return last[1](spark, docs, sf_dir)
