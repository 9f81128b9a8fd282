"""License scans: phrases, and an exact set-similarity join of text blocks
with license templates.

A block is a line, or a window of a longer one: windows of twice the
longest template, a template's length apart, so that any run as long as a
template lies in one of them whole. A block meets a template if it holds
at least ``PERCENT`` of the template's distinct words.

The join orders words by the number of documents that hold them, rarest
first. A block can only meet a template if the first of their common words
is among the first |T| - need + 1 of the template (prefix filter), the block
holds at least ``need`` template words (length filter) and enough words are
left from that first one on in both (position filter). What passes is
verified exactly. Words that no template has count for nothing and are left
out of the blocks' lists.

DataFrame functions only. The templates are fixed values, so everything of
their size is a constant of the plan.

Defined results: null or empty text has no words and no labels; each row
gets its result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import written

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PERCENT = 90
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
# Opening words of public license texts and usual notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def tokens(text: str) -> list[str]:
    return sorted(set(text.split()))


def need(words: list[str]) -> int:
    """Words of a template that a block must hold."""
    return -(-PERCENT * len(words) // 100)


LONGEST = max(len(text.split()) for _, text in TEMPLATES)
VOCABULARY = sorted({w for _, text in TEMPLATES for w in text.split()})


def words_of(text: Column) -> Column:
    """Lower-cased words."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.translate(w, UPPER, LOWER))


def strings(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def document_frequency(documents: DataFrame) -> dict[str, int]:
    """Documents that hold each word of the vocabulary; a row per word is
    collected. The counts only set the order, and any order gives right
    results, so one lower() of the text stands in for that of A-Z alone."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    held = F.array_intersect(words, strings(VOCABULARY))
    counted = documents.select(F.explode(held).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}


def _templates(spark, order: list[str]) -> DataFrame:
    """A row for each prefix word of each template."""
    rows = []
    for label, text in TEMPLATES:
        words = [w for w in order if w in set(text.split())]
        for at in range(len(words) - need(words) + 1):
            rows.append((words[at], label, words, need(words), at))
    return spark.createDataFrame(rows, "word string, label string, words array<string>, need int, at int")


def _starts(words: str, phrase: str) -> Column:
    """Positions where the words of a phrase stand consecutively."""
    parts = phrase.split()

    def here(word: Column, at: Column) -> Column:
        same = word == parts[0]
        for k in range(1, len(parts)):
            same &= F.coalesce(F.get(words, at + k) == parts[k], F.lit(False))
        return F.when(same, at.cast("bigint"))

    return F.array_compact(F.transform(words, here))


def _base(words: str) -> tuple[Column, Column]:
    """Starts of the phrases, and the labels of those that occur."""
    spots = [_starts(words, phrase) for phrase, _ in PHRASES]
    labels = [F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(spots, PHRASES)]
    return F.concat(*spots), F.array_compact(F.array(*labels))


def _blocks(candidates: DataFrame) -> DataFrame:
    """(row, block): the words of each block."""
    lines = candidates.select("row", F.explode(F.split("text", "\n")).alias("line"))
    every = lines.select("row", words_of(F.col("line")).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - LONGEST, F.lit(1)), F.lit(LONGEST))
    return every.select("row", "words", F.explode(starts).alias("start")).select(
        "row", F.expr(f"slice(words, start, {2 * LONGEST})").alias("block")
    )


def meeting(candidates: DataFrame, order: list[str]) -> DataFrame:
    """(row, label, share) of the blocks that meet a template."""
    prefixes = _templates(candidates.sparkSession, order)
    ordered = _blocks(candidates).select("row", F.array_intersect(strings(order), F.col("block")).alias("held"))
    spread = ordered.select("row", "held", F.posexplode("held").alias("place", "word"))
    pairs = spread.join(prefixes, "word").where(
        (F.size("held") >= F.col("need"))
        & (F.size("held") - F.col("place") >= F.col("need"))
        & (F.size("words") - F.col("at") >= F.col("need"))
    )
    common = F.size(F.array_intersect("held", "words"))
    return pairs.where(common >= F.col("need")).select("row", "label", (common / F.size("words")).alias("share"))


def license_scan(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (1 for a phrase, else the largest share of a
    template that a block holds)."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    frequency = document_frequency(docs)
    order = sorted(VOCABULARY, key=lambda w: (frequency.get(w, 0), w))
    leading = sorted(
        {p for phrase, _ in PHRASES for p in phrase.split()[-1:]}
        | {r for _, text in TEMPLATES for r in [w for w in order if w in set(text.split())][: len(tokens(text)) - need(tokens(text)) + 1]}
    )
    edge = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
    leads = F.col("text").rlike(f"(?i)(?<!{edge})(?:{'|'.join(leading)})(?!{edge})")
    plain = docs.where(~leads).select(
        "doc_id", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_base"), F.lit(None).cast("bigint").alias("first_word"),
        F.lit(None).cast("bigint").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"),
        F.lit(0.0).alias("score"),
    )
    candidates = written(
        docs.where(leads).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "license-texts"
    )
    found = meeting(candidates, order).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share")
    )
    spots, own = _base("words")
    based = candidates.select("row", "doc_id", words_of(F.col("text")).alias("words")).select(
        "row", "doc_id", F.size("words").cast("bigint").alias("n_words"), spots.alias("spots"), own.alias("own")
    )
    joined = based.join(found, "row", "left")
    every = F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))
    scanned = joined.select(
        "doc_id", "n_words", F.size("spots").cast("bigint").alias("n_base"),
        F.array_min("spots").alias("first_word"), F.array_max("spots").alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("spots") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
    return plain.unionByName(scanned)
