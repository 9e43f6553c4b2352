"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, mixing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its rows are written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontamination, exact_dedup, language_id, mixing, near_dedup
from footfall.llm.shared import staged, table, unused


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dedup.deduplicate(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``."""
    taken = mixing.mix(docs).where("copies > 0")
    docs = docs.drop(*set(taken.columns) - {"doc_id"})
    name = unused(docs, "_taken")
    taken = taken.distinct().withColumnRenamed("doc_id", name)
    return docs.join(taken, F.col("doc_id").eqNullSafe(F.col(name))).drop(name)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_leaks),
    ("mixing", mixed_sources),
]

#: Naive Bayes over hashed n-grams is not expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
