"""A corpus pipeline from the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
one before it kept; its result is written as Parquet and read again as the
next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantlens.llm import decontaminate, line_dedup, mixing, ngram_join, quality_classifier
from plantlens.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that documents share stay in the first one only."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("mixing sources to target weights", mix_sources),
]

#: The first stage is a trained model, which SQL cannot express; tests hold
#: the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
