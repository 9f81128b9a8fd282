"""Language identification by rank-order profiles.

A profile is a language's most frequent character n-grams in the order of
their counts. A document is ranked in the same way, and its distance to a
language is the sum, over the document's n-grams, of how far each stands
from its place in the profile ("out of place"); an n-gram the profile does
not have counts as far as can be. The nearest language wins.

N-grams are one to three characters long, of lower-cased words with one
blank at either end; whatever is not a letter is a blank. A profile holds
the ``PLACES`` most frequent of all training texts, ties in code point
order, and so does a document.

Counting is one pass of Arrow batches: a batch's n-grams are sorted and
counted at once, summed per language in Spark, and ranked by a limited
window, which drops what cannot be among the first before it shuffles. The
second pass ranks each document and compares. Profiles are broadcast in
blocks of ``BLOCK`` languages, at most BLOCK * PLACES rows each; further
blocks are further passes over the texts, each written before the next.

Bounds in a task: a batch holds at most 512 rows and about SLICE_BYTES of
text, or one text; a text's n-grams are counted in windows of ``WINDOW``
characters, so a long text costs its own length and its distinct n-grams.

Defined results: a text that is null or has no letter is ``und`` with score
0, and so is every text where no language was learned; rows without id are
held to crc32 of the empty string; equal distances go to the language first
in code point order; equal rows get equal results; only doc_id, text and
lang are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlens.llm.common import fold, shipped, written
from plantlens.llm.text import slices

PLACES = 400
BLOCK = 256
UNKNOWN = "und"
ROWS = 512  # of a batch: 9 bits, beside three letters of 18
WINDOW = 1 << 20
BITS = 18
BLANK = 1  # code of a blank; 0 is no character


@functools.cache
def letters() -> np.ndarray:
    """Code point -> its number among the letters, from 2 on; others are a
    blank."""
    own = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(own, np.cumsum(own) + BLANK, BLANK).astype(np.int64)


def codes(text: str | None) -> np.ndarray:
    """Letter numbers of the lower-cased words of a text, one blank between,
    before and after them; empty without a letter. Numbers keep the order
    of the code points."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    own = np.concatenate(([BLANK], letters()[points], [BLANK]))
    own = own[(own != BLANK) | np.r_[True, own[:-1] != BLANK]]
    return own if len(own) > 1 else own[:0]


def keys(own: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of ``codes`` as packed numbers, in windows."""
    for start in range(0, len(own), WINDOW):
        a = own[start : start + WINDOW]
        b, c = own[start + 1 : start + WINDOW + 1], own[start + 2 : start + WINDOW + 2]
        two = (a[: len(b)] << 2 * BITS) | (b << BITS)
        three = (two[: len(c)] | c)[b[: len(c)] != BLANK]
        yield np.concatenate((a[a != BLANK] << 2 * BITS, two, three))


def totals(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(count, first)


def counted(parts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count) of (group, codes), ascending by group and
    n-gram; groups are below ROWS."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[np.ndarray] = []
    size = 0

    def count() -> None:
        nonlocal size
        if held:
            found.append(np.unique(np.concatenate(held), return_counts=True))
        held.clear()
        size = 0

    for group, own in parts:
        for some in keys(own):
            held.append(some | (group << 3 * BITS))
            size += len(some)
            if size >= 4 * WINDOW:
                count()
    count()
    if not found:
        return (np.zeros(0, np.int64),) * 3
    key, n = found[0] if len(found) == 1 else totals(*map(np.concatenate, zip(*found)))
    return key >> 3 * BITS, key & ((1 << 3 * BITS) - 1), n


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ROWS rows."""
    for batch in slices(batches):
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        place = {name: k for k, name in enumerate(names)}
        group, gram, n = counted([(place[x], codes(t)) for x, t in zip(langs, batch.column("text").to_pylist())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array(group)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"]
        )


def profiles(training: DataFrame, places: int = PLACES) -> DataFrame:
    """(lang, gram, place): the first ``places`` n-grams of each language of
    (lang, text), places from 0."""
    texts = training.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    sums = texts.mapInArrow(_learn, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    upward = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = sums.withColumn("place", F.row_number().over(upward)).where(F.col("place") <= places)
    return ranked.select("lang", "gram", (F.col("place") - 1).cast("int").alias("place"))


class Profiles:
    """The profiles of one block of languages."""

    def __init__(self, rows: list[tuple[str, int, int]], places: int):
        self.places = places
        self.langs = sorted({lang for lang, _, _ in rows})
        column = {lang: k for k, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.place = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for lang, gram, place in rows:
            self.place[column[lang], np.searchsorted(self.grams, gram)] = place

    def distances(self, group: np.ndarray, gram: np.ndarray, n: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums out of place, one row a language and one column a group, and
        the number of n-grams compared in each group."""
        order = np.argsort(group * (n.max() + 1) + (n.max() - n), kind="stable")
        group, gram = group[order], gram[order]
        first = np.searchsorted(group, np.arange(groups))
        place = np.arange(len(group)) - first[group]
        own = place < self.places
        group, gram, place = group[own], gram[own], place[own]
        at = np.searchsorted(self.grams, gram)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != gram] = len(self.grams)
        out = np.empty((len(self.langs), groups))
        for k, row in enumerate(self.place):
            there = row[at]
            far = np.where(there < 0, self.places, np.abs(there - place))
            out[k] = np.bincount(group, far, groups)
        return out, np.bincount(group, minlength=groups)


def _nearest(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Profiles = sent()
        for batch in small(batches):
            texts = [codes(t) for t in batch.column("text").to_pylist()]
            group, gram, n = counted(list(enumerate(texts)))
            best = np.array(batch.column("score").to_pylist(), float)
            pred = batch.column("lang_pred").to_pylist()
            if len(group):
                distance, compared = own.distances(group, gram, n, len(texts))
                near = distance.argmin(axis=0)  # the first of equals
                score = 1 - distance[near, np.arange(len(texts))] / (own.places * np.maximum(compared, 1))
                for k in np.flatnonzero((compared > 0) & ((best < score) | [p == UNKNOWN for p in pred])):
                    best[k], pred[k] = score[k], own.langs[near[k]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(pred, pa.string()), pa.array(best)],
                ["doc_id", "text", "lang_pred", "score"],
            )

    return run


def identify(texts: DataFrame, learned: DataFrame, places: int = PLACES, block: int = BLOCK) -> DataFrame:
    """(doc_id, lang_pred, score) of (doc_id, text) by written profiles;
    the score is 1 at no distance and 0 at the greatest."""
    spark: SparkSession = texts.sparkSession
    scored = texts.select("doc_id", "text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    schema = "doc_id bigint, text string, lang_pred string, score double"
    names = learned.select("lang").distinct()
    limits = [r.lang for r in _block_starts(names, block).collect()]
    for start, stop in zip(limits, [*limits[1:], None]):
        if start != limits[0]:
            scored = written(scored, "language-block")
        own = learned.where(F.col("lang") >= start)
        own = own if stop is None else own.where(F.col("lang") < stop)
        rows = [(r.lang, r.gram, r.place) for r in own.collect()]  # at most block * places
        scored = scored.mapInArrow(_nearest(shipped(spark, Profiles(rows, places))), schema)
    return scored.drop("text")


def _block_starts(names: DataFrame, block: int) -> DataFrame:
    """The first language of each block."""
    number = F.row_number().over(Window.orderBy("lang"))
    return names.withColumn("number", number).where(F.col("number") % block == 1 % block).select("lang").orderBy("lang")


def languages(documents: DataFrame, places: int = PLACES, folds: int = 5, held: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learned from the
    documents outside the held-out fold."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    learned = written(profiles(docs.where(fold(F.col("doc_id"), folds) != held), places), "language-profiles")
    return identify(docs, learned, places).select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score"
    )
