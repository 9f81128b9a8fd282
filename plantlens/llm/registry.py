"""Queries of the training-data operators, with their SQL where there is
one. Each query applies an operator with its production settings to its
whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantlens.llm import (
    collocations,
    decontaminate,
    fill_middle,
    language_id,
    license_scan,
    line_dedup,
    lm_score,
    mixing,
    ngram_join,
    pii,
    quality_classifier,
    quality_rules,
    toxicity,
)
from plantlens.llm import sql as S
from plantlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shared by documents, kept only in the first."""
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by their 4-word shingles."""
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).drop("class_id")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules with thresholds per language and source."""
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.drop("lang", "source", "n_lines")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every text."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text."""
    return quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in the documents."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by rank-order profiles."""
    return language_id.languages(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut and put in order for filling the middle."""
    return fill_middle.digest(fill_middle.fill_middle(table(spark, sf_dir, "documents")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_mix,
        op3_line_dedup,
        op4_ngram_join,
        op5_license_scan,
        op6_quality_rules,
        op7_lm_score,
        op8_quality,
        op9_decontaminate,
        op10_pii,
        op11_language_id,
        op12_fill_middle,
        op13_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_mix": S.MIX,
    "op3_line_dedup": S.LINE_DEDUP,
    "op4_ngram_join": S.NGRAM_JOIN,
    "op5_license_scan": S.LICENSE_SCAN,
    "op6_quality_rules": S.QUALITY_RULES,
    "op9_decontaminate": S.DECONTAMINATE,
    "op12_fill_middle": S.FILL_MIDDLE,
    "op13_collocations": S.COLLOCATIONS,
}
