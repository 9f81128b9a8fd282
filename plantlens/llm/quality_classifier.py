"""Quality scores learnt from preference pairs (Bradley-Terry).

A document of good quality is preferred to one of bad quality. The
probability that a is preferred to b is the logistic function of the
difference of their scores, and a score is linear in features of the text;
so the weights are those of a logistic regression on feature differences
of pairs, without a bias. The threshold is the quantile of the labelled
documents' scores that equals the share of bad ones.

Features are shares and means of the text, each cut into ``BINS`` bins at
quantiles of the labelled sample, so that a score can rise and fall along
a feature.

The model is fitted on at most ``SAMPLE`` labelled documents and ``PAIRS``
pairs for each bad one.

Defined results: null text is empty; an empty text is scored by its bins as
any other; without labels of both kinds every score is 0.5 and every
document is kept; each row gets its score; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fold, shipped
from plantlens.llm.learning import labelled_sample, logistic, sigmoid
from plantlens.llm.quality_rules import NOT_IN_WORDS, SYMBOLS, repeat_words
from plantlens.llm.text import raw, slices

BINS = 10
SAMPLE = 20_000
PAIRS = 20
THRESHOLD = 0.3
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b".,;:?"
SHOUTS = b"!"


def features(text: bytes) -> tuple[float, ...]:
    """Counts and shares of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    letters = max(len(text.translate(None, NOT_IN_WORDS)), 1)
    total = max(len(words), 1)

    def share(characters: bytes) -> float:
        return (len(text) - len(text.translate(None, characters))) / letters

    return (
        float(np.log1p(len(words))),
        letters / total,
        len(set(words)) / total,
        repeat_words(words) / total,
        sum(a == b for a, b in zip(words, words[1:])) / total,
        len(set(lines)) / max(len(lines), 1),
        float(np.log1p(total / max(len(lines), 1))),
        share(SYMBOLS),
        share(UPPER),
        share(DIGITS),
        share(MARKS),
        share(SHOUTS),
    )


@dataclass
class Model:
    cuts: list[np.ndarray]
    weights: np.ndarray
    threshold: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        """One column per bin: 1 where the feature lies in it."""
        columns = [np.eye(len(cut) + 1)[np.searchsorted(cut, x[:, k], side="right")] for k, cut in enumerate(self.cuts)]
        return np.hstack(columns) if columns else np.zeros((len(x), 0))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.bins(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; THRESHOLD at the score quantile that parts good and bad."""
        if not self.cuts:
            return np.full(len(x), 0.5)
        return sigmoid(self.raw(x) - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD)))


def measured(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), -1)


def fit(documents: DataFrame, labels: DataFrame, *, folds: int, held: int, sample: int, pairs: int) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = measured(raw(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    rows = labelled_sample(documents, labels, "quality", folds, held, sample)
    seen = rows.mapInArrow(run, "label int, x array<double>").orderBy("label", "x").collect()
    good = np.array([r["x"] for r in seen if r["label"] == 1])
    bad = np.array([r["x"] for r in seen if r["label"] == 0])
    if not (len(good) and len(bad)):
        return Model([], np.zeros(0), 0.0)
    both = np.vstack([good, bad])
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in both.T]
    # Bad documents are the fewer: their own quantiles make bins as well.
    cuts = [np.unique(np.r_[cut, np.quantile(c, [0.1, 0.5, 0.9])]) for cut, c in zip(cuts, bad.T)]
    model = Model(cuts, np.zeros(0), 0.0)
    draw = np.random.default_rng(0)
    worse = np.repeat(np.arange(len(bad)), pairs)
    better = draw.integers(len(good), size=len(worse))
    x_good, x_bad = model.bins(good), model.bins(bad)
    model.weights = logistic(x_good[better] - x_bad[worse], np.ones(len(worse)))
    scores = model.raw(both)
    model.threshold = _between(scores, len(bad) / len(both))
    return model


def _between(scores: np.ndarray, share: float) -> float:
    """The quantile, moved to the middle of the gap it falls in."""
    at = np.quantile(scores, share, method="lower")
    above = scores[scores > at]
    return float((at + above.min()) / 2) if len(above) else float(at)


def quality(
    documents: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, sample: int = SAMPLE, pairs: int = PAIRS,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = shipped(
        documents.sparkSession, fit(documents, labels, folds=folds, held=held, sample=sample, pairs=pairs)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model()
        for batch in slices(batches):
            score = own.score(measured(raw(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = docs.mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _with_text_column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (row), with the text of the row as a column."""
    for batch in batches:
        row = batch.column("row")
        yield pa.RecordBatch.from_arrays([row, row.field("text")], ["row", "text"])


def keep_good(
    documents: DataFrame, labels: DataFrame, *, folds: int = 5, held: int = 0, sample: int = SAMPLE, pairs: int = PAIRS,
) -> DataFrame:
    """``documents`` without those scored below the threshold; all columns
    stay, and nothing is shuffled."""
    model = shipped(
        documents.sparkSession, fit(documents, labels, folds=folds, held=held, sample=sample, pairs=pairs)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model()
        for batch in slices(_with_text_column(batches)):
            good = own.score(measured(raw(batch.column("text")))) >= THRESHOLD
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(good))], ["row"])

    rows = documents.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, rows.schema).select("row.*")
