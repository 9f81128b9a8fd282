"""Quality rules with thresholds learned per language and source.

Every document gets ratios (symbols, repeated lines, repeated words, word
length). Per language and source each ratio is summed up in a mergeable
quantile sketch with logarithmic buckets: a bucket is a count, sketches
merge by adding counts, and a quantile is exact to one per cent of its
value. Median and upper quartile then set a fence for that group, and the
documents are joined with the fences of their group.

A fence stands ``SPREADS`` spreads beyond the median and never closer to it
than the rule's slack, so that a group of uniform documents keeps them all.

Defined results: null text has no words and no lines with a word; a null
language or source is a group of its own; a ratio of an empty text is 0;
each row gets its result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import written
from plantlens.llm.text import raw, slices

GAMMA = 1.02
SPREADS = 4.0
SYMBOLS = b"#*$%&|<>"
NOT_IN_WORDS = bytes([*range(0x09, 0x0E), 0x20, *range(0x80, 0xC0)])  # blanks; UTF-8 continuations


@dataclass(frozen=True)
class Rule:
    """A ratio, its slack around the median, and whether low values fail
    too."""

    name: str
    over: str
    under: str
    slack: float
    both: bool = False

    def ratio(self) -> Column:
        return F.col(self.over) / F.greatest(F.col(self.under), F.lit(1))


RULES = (
    Rule("symbols", "n_symbols", "word_chars", 0.05),
    Rule("dup_lines", "n_dup_lines", "n_lines", 0.50),
    Rule("repeat_words", "n_repeat_words", "n_words", 0.25),
    Rule("word_length", "word_chars", "n_words", 3.0, both=True),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, counts = np.unique(
        pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    hit = counts[window] >= 2
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(hit)] |= hit
    return int(inside.sum())


def counts(text: bytes) -> tuple[int, ...]:
    """COUNTS of one text."""
    words = text.split()
    lines = Counter(line for line in text.split(b"\n") if line and not line.isspace())
    total = sum(lines.values())
    return (
        len(words),
        len(text.translate(None, NOT_IN_WORDS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        total,
        total - len(lines),
        repeat_words(words),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = np.array([counts(t) for t in raw(batch.column("text"))], dtype=np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "lang", "source")] + [pa.array(rows[:, i]) for i in range(len(COUNTS))],
            ["doc_id", "lang", "source", *COUNTS],
        )


def measured(documents: DataFrame) -> DataFrame:
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), "text",
    )
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return docs.mapInArrow(_count, schema)


# --- sketches --------------------------------------------------------------------


def bucket(value: Column) -> Column:
    """Number of the logarithmic bucket; null for 0."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GAMMA)).cast("int"))


def sketches(measures: DataFrame) -> DataFrame:
    """Counts per (lang, source, rule, bucket). Sketches of parts merge by
    adding the counts."""
    ratios = F.array(*(F.struct(F.lit(r.name).alias("rule"), bucket(r.ratio()).alias("bucket")) for r in RULES))
    flat = measures.select("lang", "source", F.inline(ratios))
    return flat.groupBy("lang", "source", "rule", "bucket").agg(F.count("*").alias("n"))


def fences(parts: DataFrame) -> DataFrame:
    """Per language and source: {rule}_low and {rule}_high."""
    merged = parts.groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("lang", "source", "rule")
    upward = group.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("upto", F.sum("n").over(upward)).withColumn("total", F.sum("n").over(group))
    value = F.coalesce(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (1 + GAMMA), F.lit(0.0))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), value))

    found = ranked.groupBy("lang", "source", "rule").agg(
        quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3")
    )
    columns = []
    for rule in RULES:
        own = F.col("rule") == rule.name
        low = F.col("q2") - F.greatest(SPREADS * (F.col("q2") - F.col("q1")), F.lit(rule.slack))
        high = F.col("q2") + F.greatest(SPREADS * (F.col("q3") - F.col("q2")), F.lit(rule.slack))
        columns += [F.max(F.when(own, low)).alias(f"{rule.name}_low"), F.max(F.when(own, high)).alias(f"{rule.name}_high")]
    return found.groupBy("lang", "source").agg(*columns)


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """Measures with base_failed and kept."""
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = F.lit(True)
    for rule in RULES:
        good &= rule.ratio() <= F.col(f"{rule.name}_high")
        if rule.both:
            good &= rule.ratio() >= F.col(f"{rule.name}_low")
    return measures.join(limits, same, "left").select(
        *measures.columns, failed.alias("base_failed"), (~failed & good).alias("kept")
    )


def quality_rules(documents: DataFrame) -> DataFrame:
    """Per document its counts, base_failed and kept."""
    measures = written(measured(documents), "quality-measures")
    return judged(measures, fences(sketches(measures)))
