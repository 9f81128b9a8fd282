"""Toxicity by a subsequence string kernel machine with Nystroem landmarks.

The kernel compares strings by all common subsequences of ``ORDER``
letters; every letter that a subsequence spans, gaps included, costs a
factor ``DECAY``. "idxiot" or "stuupid" therefore stay close to the insult.
Units are the words of a text, without inserted signs and digits
("id.io-t"), and the strings that runs of single characters spell
("i d i o t").

Landmarks are the words that toxic labelled texts hold far more often than
others. A text is described by its closest unit to each landmark; the
Nystroem features of that profile feed a linear support vector machine,
fitted on labelled texts and calibrated to probabilities.

A unit is compared with a landmark if it has ORDER of its letters in the same
order; elsewhere the kernel is 0. Units longer than ``WIDTH`` are compared in overlapping windows.

The model is fitted on at most ``SAMPLE`` labelled texts.

Defined results: null and empty texts are scored as texts far from all landmarks;
without labels of both kinds every score is the share of toxic labels (0
without labels); each row gets its score; only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fold, shipped
from plantlens.llm.learning import labelled_sample, logistic, sigmoid, svm
from plantlens.llm.text import raw, slices

ORDER = 4
DECAY = 0.7
LEAST = 0.1
WIDTH = 24
LANDMARKS = 128
ODDS = 0.1  # of a landmark in other texts, against toxic ones
SURE = 5.0  # standard errors
SAMPLE = 20_000
CACHE_UNITS = 300_000
CHUNK = 1024
ORDERED = 1 << 14  # pairs whose letters are compared in order at once
ROUNDING = 1e-4  # far more than single precision loses in sums of positive numbers
SLICE_BYTES = 4 << 20
THRESHOLD = 0.3
SPELLED = re.compile(rb"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")
BLANKS = b" \t\n\x0b\x0c\r"
#: ASCII characters that are neither letters nor blanks.
INSERTED = bytes(c for c in range(128) if c not in BLANKS and not chr(c).isalpha())
#: Blanks as spaces, all else as x: the shape of SPELLED is a plain string.
SHAPE = bytes(32 if c in BLANKS else 120 for c in range(256))
LETTERS = re.compile(rb"[^a-z\x80-\xff]+")


def units(text: bytes) -> list[bytes]:
    """Words of lower-cased text without inserted signs and digits, and what
    runs of single characters spell; cut into windows where they are long."""
    text = text.lower()
    found = text.translate(None, INSERTED).split()
    if b" x x x " in b" %b " % text.translate(SHAPE):
        found += [b"".join(run.split()).translate(None, INSERTED) for run in SPELLED.findall(text)]
    if max(map(len, found), default=0) > WIDTH:
        half = WIDTH // 2
        found = [u[at : at + WIDTH] for u in found for at in range(0, max(len(u) - half, 1), half)]
    return found


# --- the kernel --------------------------------------------------------------------


def matrix(strings: list[bytes]) -> np.ndarray:
    """Bytes of the strings, one row each, padded with 0."""
    return np.array(strings, dtype=f"S{WIDTH}").view(np.uint8).reshape(-1, WIDTH)


#: The bit of each byte: one for each of a-z, six for all of other scripts.
SLOTS = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 if c >= 128 else -1 for c in range(256)])


def letter_bits(rows: np.ndarray) -> np.ndarray:
    """Letters held once (low half) and twice (high half), as bits."""
    once, twice = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
    for column in SLOTS[rows].T:
        bit = np.where(column >= 0, np.uint64(1) << np.maximum(column, 0).astype(np.uint64), np.uint64(0))
        twice |= once & bit
        once |= bit
    return once | (twice << np.uint64(32))


def fewest_bits(row: np.ndarray) -> int:
    """The fewest bits that ORDER letters of a landmark may set."""
    slots, left, bits = SLOTS[row], ORDER, 0
    for held in sorted(np.bincount(slots[slots >= 0]), reverse=True):
        bits += min(held, left, 2)
        left -= min(held, left)
    return bits


def kernel(match: list[np.ndarray], kind: type = np.float64) -> np.ndarray:
    """Subsequence kernel of pairs of strings, one pair per column:
    ``match[i]`` tells for the first string's character i where the second
    string has it. What a common subsequence costs depends on where it
    starts and ends: ``sums`` adds those that end at a pair of characters by
    their starts, then up to each pair."""
    match = np.asarray(match).astype(kind)
    rows, columns = len(match) - ORDER + 1, len(match[0]) - ORDER + 1
    if rows < 1 or columns < 1:
        return np.zeros(match[0].shape[1], kind)
    at = DECAY ** np.add.outer(np.arange(rows), np.arange(columns))[:, :, None]
    # The k-th letter (from 0) of ORDER has k characters before it and
    # ORDER - 1 - k after it, in both strings.
    sums = match[:rows, :columns] * (1 / at).astype(kind)
    for k in range(1, ORDER):
        for j in range(1, columns):
            sums[:, j] += sums[:, j - 1]
        for i in range(1, rows):
            sums[i] += sums[i - 1]
        sums *= match[k : k + rows, k : k + columns]
    sums *= (DECAY ** (2 * ORDER) * at).astype(kind)
    return sums.reshape(rows * columns, -1).sum(axis=0)


def closeness(rows: np.ndarray, landmarks: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Kernel of each column of ``rows`` with the same column of
    ``landmarks``, over the landmark's letters; other letters only widen
    gaps. The cosine (cubed, so that only what is nearly equal counts) tells
    how much else the row holds of these letters, the kernel relative to
    the landmark's own (``alone``) how wide the gaps are. Below LEAST, which
    the cosine cannot raise, it counts as 0; single precision tells where it
    is far below."""
    match = rows == landmarks[:, None]
    out = np.zeros(rows.shape[1])
    near = np.flatnonzero(kernel(match, np.float32) >= (1 - ROUNDING) * LEAST * alone)
    if len(near):
        both = kernel(match[:, :, near])
        over = both >= LEAST * alone[near]
        near, both = near[over], both[over]
    if len(near):
        rows, landmarks, alone = rows[:, near], landmarks[:, near], alone[near]
        own = np.zeros(rows.shape, dtype=bool)
        for letter in landmarks:
            own |= rows == letter
        itself = kernel([(rows == c) & own & mine for c, mine in zip(rows, own)])
        out[near] = (both / np.sqrt(np.maximum(itself, 1e-12) * alone)) ** 3 * np.minimum(both / alone, 1)
    return out


@dataclass
class Landmarks:
    words: list[bytes]

    def __post_init__(self):
        self.rows = matrix(self.words)
        self.sizes = (self.rows != 0).sum(axis=1)
        self.bits = letter_bits(self.rows)
        self.least = np.array([fewest_bits(row) for row in self.rows])
        self.spots = np.zeros((len(self.words), 256), np.uint32)  # of each byte in the landmark, as bits
        for k, word in enumerate(self.words):
            for at, c in enumerate(word):
                self.spots[k, c] |= np.uint32(1 << at)
        self.alone = np.array([self._alone(k) for k in range(len(self.words))])
        near = self.closeness(self.words)
        values, vectors = np.linalg.eigh((near + near.T) / 2)
        self.basis = vectors / np.sqrt(np.maximum(values, 1e-2))

    def _alone(self, k: int) -> float:
        own = self.rows[k, : self.sizes[k], None]
        return kernel([own == c for c in own])[0]

    def ordered(self, rows: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Whether each row has ORDER letters of its landmark in the same
        order: the longest common subsequence, bit by bit."""
        first, left = marks * 256, np.full(len(rows), 2**32 - 1, np.uint32)
        for column in rows.T:
            met = left & self.spots.ravel().take(first + column)
            left = (left + met) | (left - met)
        inside = (np.uint32(1) << self.sizes[marks].astype(np.uint32)) - np.uint32(1)
        return np.bitwise_count(~left & inside) >= ORDER

    def closeness(self, strings: list[bytes]) -> np.ndarray:
        """Kernel of each string with each landmark; 1 for the landmark."""
        rows = matrix(strings)
        bits, sizes = letter_bits(rows), (rows != 0).sum(axis=1)
        out = np.zeros((len(rows), len(self.words)))
        for size in np.unique(self.sizes):
            # Pairs with landmarks of one size, strings of like size together.
            marks = np.flatnonzero(self.sizes == size)
            near = [np.flatnonzero(np.bitwise_count(bits & self.bits[k]) >= self.least[k]) for k in marks]
            string, mark = np.concatenate(near), np.repeat(marks, [len(x) for x in near])
            order = np.argsort(sizes[string].astype(np.uint8), kind="stable")
            string, mark = string[order], mark[order]
            kept = [
                self.ordered(rows[own, : int(sizes[own].max())], mark[at : at + ORDERED])
                for at in range(0, len(string), ORDERED)
                for own in [string[at : at + ORDERED]]
            ]
            kept = np.concatenate([*kept, np.empty(0, bool)])
            string, mark = string[kept], mark[kept]
            for at in range(0, len(string), CHUNK):
                own, k = string[at : at + CHUNK], mark[at : at + CHUNK]
                width = int(sizes[own].max())
                out[own, k] = closeness(rows[own, :width].T, self.rows[k, :size].T, self.alone[k])
        return out

    def features(self, near: np.ndarray) -> np.ndarray:
        """Nystroem features."""
        return near @ self.basis


class Profile:
    """How close a text comes to each landmark, by its closest unit."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.known: set[bytes] = set()
        self.near: dict[bytes, np.ndarray] = {}

    def of(self, texts: list[bytes]) -> np.ndarray:
        """Closeness to the landmarks, a row for each text."""
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
            self.near.clear()
        every = [set(units(t)) for t in texts]
        new = list(set().union(*every).difference(self.known))
        for at in range(0, len(new), 1 << 16):
            part = new[at : at + (1 << 16)]
            rows = self.landmarks.closeness(part)
            self.near.update((part[k], rows[k].copy()) for k in np.flatnonzero(rows.any(axis=1)))
        self.known.update(new)
        out, near = np.zeros((len(texts), len(self.landmarks.words))), set(self.near)
        for k, own in enumerate(every):
            close = [self.near[unit] for unit in own & near]
            if close:
                out[k] = np.maximum.reduce(close)
        return out


# --- fitting ------------------------------------------------------------------------


def find_landmarks(sample: DataFrame, most: int) -> Landmarks | None:
    """The words that toxic texts hold far more often than others do, beyond
    chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), raw(batch.column("text"))):
                words = {LETTERS.sub(b"", w) for w in text.lower().split()}
                held[label].update(w for w in words if ORDER <= len(w) <= WIDTH)
        rows = [(label, w, n) for label, own in held.items() for w, n in own.items()]
        names = ("label", "word", "n")
        kinds = (pa.int32(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], list(names)
        )

    # Copies of a text count once: texts of one label with the same smallest
    # hash of three words.
    split = sample.withColumn("words", F.split(F.lower("text"), r"\s+"))
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    sample = split.withColumn("same", F.array_min(hashes)).dropDuplicates(["label", "same"])

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    counts = sample.select("label", "text").mapInArrow(run, "label int, word binary, n bigint")
    held = [F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in (0, 1)]
    plain, toxic = (held[k] / sizes[k] for k in (0, 1))
    pooled = (held[0] + held[1]) / sum(sizes.values())
    spread = F.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]))
    ranked = (
        counts.groupBy("word").agg(toxic.alias("toxic"), plain.alias("plain"), spread.alias("spread"))
        .withColumn("lead", F.col("toxic") - F.col("plain"))
        .where(f"plain <= {ODDS} * toxic and lead >= {SURE} * spread")
        .orderBy(F.desc("lead"), "word").limit(most)
    )
    words = [bytes(r["word"]) for r in ranked.collect()]
    return Landmarks(words) if words else None


@dataclass
class Model:
    landmarks: Landmarks | None
    weights: np.ndarray
    scale: np.ndarray  # of the calibration: slope and offset

    def score(self, closeness: np.ndarray) -> np.ndarray:
        if self.landmarks is None:
            return np.full(len(closeness), self.scale[1])
        margin = self.landmarks.features(closeness) @ self.weights[:-1] + self.weights[-1]
        return sigmoid(margin * self.scale[0] + self.scale[1])


def fit(documents: DataFrame, labels: DataFrame, *, folds: int, held: int, sample: int, landmarks: int) -> Model:
    rows = labelled_sample(documents, labels, "toxic", folds, held, sample)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    rate = counts.get(1, 0) / max(sum(counts.values()), 1)
    if not (counts.get(0) and counts.get(1)):
        return Model(None, np.zeros(1), np.array([0.0, rate]))
    found = find_landmarks(rows, landmarks)
    if not found:
        return Model(None, np.zeros(1), np.array([0.0, rate]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = Profile(found)
        for batch in slices(batches, size=SLICE_BYTES):
            x = profile.of(raw(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x))], ["label", "x"])

    seen = rows.mapInArrow(run, "label int, x array<double>").collect()
    x, y = np.array([r["x"] for r in seen]), np.array([float(r["label"]) for r in seen])
    weights = svm(found.features(x), y)
    margin = found.features(x) @ weights[:-1] + weights[-1]
    return Model(found, weights, logistic(np.c_[margin, np.ones(len(margin))], y, ridge=1e-3))


def toxicity(
    documents: DataFrame, labels: DataFrame, *, folds: int = 4, held: int = 2, sample: int = SAMPLE,
    landmarks: int = LANDMARKS, threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Labels of the
    held-out fold (crc32 of the id) are not learnt from."""
    model = shipped(
        documents.sparkSession, fit(documents, labels, folds=folds, held=held, sample=sample, landmarks=landmarks)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model()
        profile = Profile(own.landmarks) if own.landmarks else None
        for batch in slices(batches, size=SLICE_BYTES):
            texts = raw(batch.column("text"))
            closeness = profile.of(texts) if profile else np.zeros((len(texts), 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.score(closeness))], ["doc_id", "score"]
            )

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = docs.mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
