"""Language-model scores from a log-frequency Bloom filter.

Training texts give counts of words and word pairs. A count c is quantised
to q = floor(log2 c) + 1, and the filter holds the entries (n-gram, 1) ..
(n-gram, q); probing 1, 2, .. until one is absent gives q back, never too
small. The filter is cut into blocks by n-gram hash and takes ``ENTRY_BITS``
per entry at every size; no task holds more than a block. Texts are dealt
into slices by hash. Each slice sends its distinct n-grams, with their
training counts, to their blocks as packed arrays; a block builds its bits
and sends each slice the levels of its n-grams.

The probability of a word interpolates the pair estimate with the word's
own, p = w c(h, x) / c(h) + (1 - w) (c(x) + 0.5) / (N + 0.5 (V + 1)), with all
counts from the filter. The weight w depends on the frequency class of h and
is the share of its pair tokens whose pair is not seen once only.

The base score needs exact counts. Words that make up at least one of
``HEAVY`` tokens are at most ``HEAVY`` many; their counts are broadcast. The
others are joined with the table of counts, by distinct (document, word).

Words are told apart by 64-bit hashes.

Defined results: null or empty text is the end token alone; without training
texts N = V = 0, n_known is 0 and every probability is 1; each row gets its
result; only doc_id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import fold, written
from plantlens.llm.text import raw, slices

HEAVY = 1 << 22
ENTRY_BITS = 8
SLICE_TOKENS = 1 << 19
BLOCK_TOKENS = 1 << 20
TASK_WORDS = 400_000
END = b"\n"  # no word holds one
CLASSES = 64
RARE = 0
WORD = 255  # class of single words


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


class Vocabulary:
    """Numbers of the distinct tokens seen by a task, and their hashes."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.hashes = np.empty(0, np.uint64)

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of the texts one after the other, and where each
        text starts. Every text ends with END."""
        number, parts, sizes = self.number.__getitem__, [], []
        for text in texts:
            words = text.lower().split()
            words.append(END)
            parts.append(np.fromiter(map(number, words), np.int64, len(words)))
            sizes.append(len(words))
        if len(self.number) > len(self.hashes):
            new = list(islice(self.number, len(self.hashes), None))
            own = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.hashes = np.concatenate([self.hashes, own])
        starts = np.cumsum([0, *sizes])[:-1]
        return np.concatenate([*parts, np.empty(0, np.int64)]), starts


def contexts(tokens: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """The token before each one; END before the first of a text."""
    before = np.concatenate([[end], tokens[:-1]]) if len(tokens) else tokens
    before[starts] = end
    return before


# --- word counts ----------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Vocabulary()
    counts = np.zeros((2, 0), np.int64)  # in training texts, in all

    def rows() -> pa.RecordBatch:
        size = len(words.hashes)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.hashes.view(np.int64)), pa.array(counts[0, :size]), pa.array(counts[1, :size])],
            ["word", "train", "every"],
        )

    for batch in slices(batches):
        tokens, starts = words.tokens(raw(batch.column("text")))
        held = np.array(batch.column("held").to_pylist(), dtype=bool)
        learnt = np.repeat(~held, np.diff([*starts, len(tokens)]))
        size = len(words.hashes)
        if size > counts.shape[1]:
            counts = np.pad(counts, ((0, 0), (0, 2 * size - counts.shape[1])))
        for row, own in zip(counts, (tokens[learnt], tokens)):
            number, n = np.unique(own, return_counts=True)
            row[number] += n
        if size > TASK_WORDS:
            yield rows()
            words.clear()
            counts = np.zeros((2, 0), np.int64)
    yield rows()


@dataclass
class Heavy:
    """Training counts of the frequent words, by sorted hash; totals."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    words: int

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is frequent, and its training count."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = self.hashes[at] == hashes
        return found, np.where(found, self.counts[at], 0)


def frequency_class(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Class of a context: RARE, or the binary magnitude of its count."""
    return np.where(found & (counts > 0), np.frexp(counts.astype(float))[1], RARE).astype(np.uint8)


def heavy_words(vocabulary: DataFrame, bound: int) -> tuple[Heavy, int]:
    """The frequent words, and the tokens of all texts."""
    total = vocabulary.agg(
        F.sum("train").alias("tokens"), F.sum("every").alias("every"), F.count(F.when(F.col("train") > 0, 1)).alias("words")
    ).first()
    frequent = vocabulary.where(F.col("every") * bound >= (total.every or 0)).select("word", "train").toArrow()
    hashes = frequent.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    found = Heavy(hashes[order], frequent.column("train").to_numpy()[order], total.tokens or 0, total.words)
    return found, total.every or 0


# --- the filter --------------------------------------------------------------------


class Slice:
    """Tokens of a slice's texts, and its distinct words and pairs by hash;
    ``pairs`` and ``alone`` tell where each token's pair and each word's own
    entry stand among them. The order of the texts does not change them."""

    def __init__(self, texts: list[bytes]):
        self.words = Vocabulary()
        self.tokens, self.starts = self.words.tokens(texts)
        self.before = contexts(self.tokens, self.starts, self.words.number[END])
        hashes = self.words.hashes
        both = np.concatenate([pair(hashes[self.before], hashes[self.tokens]), mixed(hashes)])
        self.grams, place = np.unique(both, return_inverse=True)
        self.pairs, self.alone = np.split(place, [len(self.tokens)])
        self.sizes = np.diff([*self.starts, len(self.tokens)])


def packed(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones and so on: what
    small numbers leave empty stands together, and shuffles compress it."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def unpacked(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind)[:, 0]


def _count_grams(heavy_: Callable, block_bits: int):
    """A slice's distinct words and pairs with their counts in training
    texts, packed per block: the first n-gram and the steps to the next."""

    def run(rows: pa.Table) -> pa.Table:
        own = Slice(raw(rows.column("text")))
        learnt = np.repeat(~np.array(rows.column("held").to_pylist(), dtype=bool), own.sizes)
        words = np.bincount(own.tokens, learnt, len(own.alone))
        n = np.bincount(own.pairs, learnt, len(own.grams)) + np.bincount(own.alone, words, len(own.grams))
        n, kind = n.astype(np.uint32), np.empty(len(own.grams), np.uint8)
        kind[own.alone] = WORD
        kind[own.pairs] = frequency_class(*heavy_().lookup(own.words.hashes))[own.before]
        block = (own.grams >> np.uint64(64 - block_bits)).astype(np.int64)
        used, first = np.unique(block, return_index=True)
        ends = np.append(first[1:], len(block))
        steps = np.diff(own.grams, prepend=np.uint64(0))
        steps[first] = own.grams[first]
        return pa.table(
            {
                "slice": pa.array([rows.column("slice")[0].as_py()] * len(used), pa.int64()),
                "block": pa.array(used, pa.int64()),
                **{
                    name: pa.array([packed(x[i:j]) for i, j in zip(first, ends)], pa.binary())
                    for name, x in (("grams", steps), ("counts", n), ("classes", kind))
                },
            }
        )

    return run


class Entries:
    """Bits of a block that the entries (n-gram, level) set, by probe."""

    def __init__(self, grams: np.ndarray, level: int):
        self.first = mixed(grams + np.uint64(0x9E3779B97F4A7C15 * level % 2**64))
        self.step = mixed(self.first) | np.uint64(1)

    def place(self, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
        """The bit of each entry in a block of ``size`` bits (below 2**32)."""
        return (((self.first + self.step * np.uint64(probe)) >> np.uint64(32)) * size) >> np.uint64(32)

    def keep(self, chosen: np.ndarray) -> None:
        self.first, self.step = self.first[chosen], self.step[chosen]


def _build(bits_at_most: int):
    """One block's bits, and per class its pair tokens: all, and those of
    pairs seen once."""

    def run(parts: pd.DataFrame) -> pd.DataFrame:
        grams = np.concatenate([np.frombuffer(g, np.uint64) for g in parts.grams])
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in parts.counts]).astype(np.int64)
        classes = np.concatenate([np.frombuffer(c, np.uint8) for c in parts.classes])
        order = np.argsort(grams)
        grams, counts, classes = grams[order], counts[order], classes[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        grams, counts, classes = grams[first], np.add.reduceat(counts, first), classes[first]
        learnt = counts > 0
        grams, counts, classes = grams[learnt], counts[learnt], classes[learnt]
        levels = np.frexp(counts.astype(float))[1]
        entries = int(levels.sum())
        if not entries:
            nothing = np.zeros(CLASSES, np.int64)
            return pd.DataFrame(
                {"block": [parts.block.iloc[0]], "size": [0], "probes": [1], "bits": [b""], "every": [nothing], "once": [nothing]}
            )
        size = max(64, min(ENTRY_BITS * entries, bits_at_most, 2**32 - 1))
        probes = max(1, round(size / entries * np.log(2)))
        bits = np.zeros(size, dtype=bool)
        for level in range(1, int(levels.max()) + 1):
            own = Entries(grams[levels >= level], level)
            for probe in range(probes):
                bits[own.place(probe, np.uint64(size))] = True
        pairs = classes < CLASSES
        every = np.bincount(classes[pairs], counts[pairs], CLASSES).astype(np.int64)
        once = np.bincount(classes[pairs & (counts == 1)], minlength=CLASSES).astype(np.int64)
        return pd.DataFrame(
            {
                "block": [parts.block.iloc[0]], "size": [size], "probes": [probes],
                "bits": [np.packbits(bits, bitorder="little").tobytes()], "every": [every], "once": [once],
            }
        )

    return run


def middle(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of each level."""
    levels = levels.astype(np.int64)
    return np.where(levels > 0, (2.0 ** (levels - 1) + 2.0**levels - 1) / 2, 0.0)


@dataclass
class Filter:
    """Blocks one after the other, in bytes."""

    block_bits: int
    bits: np.ndarray
    offset: np.ndarray  # first byte of each block
    size: np.ndarray  # bits of each block; 0 where nothing is held
    probes: np.ndarray

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated count of each n-gram."""
        return middle(self.levels(grams))

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Level of each n-gram, 0 if it is not held."""
        block = (grams >> np.uint64(64 - self.block_bits)).astype(np.int64)
        levels = np.zeros(len(grams), np.int64)
        live = np.flatnonzero(self.size[block] > 0)
        offset, size, probes = (x[block[live]] for x in (self.offset, self.size.astype(np.uint64), self.probes))
        level = 0
        while len(live) and level < 63:
            level += 1
            entries = Entries(grams[live], level)
            for probe in range(int(probes.max())):
                place = entries.place(probe, size)
                byte = self.bits[offset + (place >> np.uint64(3)).astype(np.int64)]
                held = (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1
                stay = np.flatnonzero((held > 0) | (probe >= probes))
                if len(stay) < len(live):
                    live, offset, size, probes = live[stay], offset[stay], size[stay], probes[stay]
                    entries.keep(stay)
                if not len(live):
                    break
            levels[live] = level
        return levels


def _levels(parts: pd.DataFrame) -> pd.DataFrame:
    """The levels of each slice's n-grams in one block; in its first row the
    pair tokens of the classes."""
    grams = [np.cumsum(unpacked(g, np.uint64), dtype=np.uint64) for g in parts.grams]
    counts = [unpacked(c, np.uint32) for c in parts.counts]
    made = _build(2**32 - 1)(parts.assign(grams=grams, counts=counts)).iloc[0]
    # Both halves of the hashes have the one block.
    size, probes = np.full(2, made["size"], np.int64), np.full(2, made.probes, np.int64)
    block = Filter(1, np.frombuffer(made.bits, np.uint8), np.zeros(2, np.int64), size, probes)
    levels = block.levels(np.concatenate(grams)).astype(np.uint8)
    cuts, rest = np.cumsum([len(g) for g in grams])[:-1], [None] * (len(parts) - 1)
    return pd.DataFrame(
        {
            "slice": parts.slice.to_numpy(), "block": parts.block.to_numpy(),
            "levels": [x.tobytes() for x in np.split(levels, cuts)], "every": [made.every, *rest], "once": [made.once, *rest],
        }
    )


def gram_levels(texts: DataFrame, heavy_: Callable, block_bits: int) -> tuple[DataFrame, np.ndarray]:
    """(slice, block, levels) of all n-grams of the texts (slice, held,
    text), and the pair weight of every context class."""
    grams = texts.groupBy("slice").applyInArrow(
        _count_grams(heavy_, block_bits), "slice bigint, block bigint, grams binary, counts binary, classes binary"
    )
    found = written(
        grams.groupBy("block").applyInPandas(
            _levels, "slice bigint, block bigint, levels binary, every array<bigint>, once array<bigint>"
        ),
        "lm-levels",
    )
    every, once = np.ones(CLASSES), np.ones(CLASSES)
    per_class = found.where("every is not null").select(F.posexplode(F.arrays_zip("every", "once")).alias("class", "n"))
    for r in per_class.groupBy("class").agg(F.sum("n.every").alias("every"), F.sum("n.once").alias("once")).collect():
        every[r["class"]] += r.every
        once[r["class"]] += r.once
    return found.select("slice", "block", "levels"), np.clip(1 - once / every, 0, 0.99)


# --- scores ------------------------------------------------------------------------


def _score(heavy_: Callable, weights: np.ndarray):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        heavy: Heavy = heavy_()
        own = Slice(raw(rows.column("text")))
        space = heavy.tokens + 0.5 * (heavy.words + 1)
        parts = answers.sort_by("block").column("levels").to_pylist()
        counts = middle(np.frombuffer(b"".join(parts), np.uint8))
        frequent, exact = heavy.lookup(own.words.hashes)
        base = np.where(frequent, np.log10((exact + 0.5) / space), 0)
        seen = frequent & (exact > 0)
        kind, estimate = frequency_class(frequent, exact), counts[own.alone]

        tokens, starts, context = own.tokens, own.starts, own.before
        joint = counts[own.pairs]
        known = np.maximum(estimate[context], joint)
        weight = np.where(known > 0, weights[kind[context]], 0)
        alone = np.minimum((estimate[tokens] + 0.5) / space, 1)
        chance = weight * joint / np.maximum(known, 1) + (1 - weight) * alone

        text = np.repeat(np.arange(len(starts)), own.sizes)
        rare = ~frequent[tokens]
        both, times = np.unique(text[rare] * len(estimate) + tokens[rare], return_counts=True)
        owner, word = both // len(estimate), both % len(estimate)
        cuts = pa.array(np.searchsorted(owner, np.arange(len(starts) + 1)), pa.int32())
        row = rows.column("slice")[0].as_py() << 32
        return pa.table(
            [
                pa.array(row + np.arange(len(starts))), rows.column("doc_id"), rows.column("held"),
                pa.array(own.sizes.astype(np.int64)),
                pa.array(np.bincount(text, seen[tokens], len(starts)).astype(np.int64)),
                pa.array(np.bincount(text, base[tokens], len(starts))),
                pa.array(np.bincount(text, np.log10(chance), len(starts))),
                pa.ListArray.from_arrays(cuts, pa.array(own.words.hashes[word].view(np.int64))),
                pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64))),
            ],
            ["row", "doc_id", "held", "n_tokens", "known", "base", "score", "word", "times"],
        )

    return run


def lm_scores(
    documents: DataFrame, *, folds: int = 5, held: int = 1, heavy: int = HEAVY, slice_tokens: int = SLICE_TOKENS
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. Texts of the held-out fold are not learnt from."""
    sc = documents.sparkSession.sparkContext
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        (fold(F.col("doc_id").cast("bigint"), folds) == held).alias("held"),
    )
    vocabulary = written(
        docs.mapInArrow(_count_words, "word bigint, train bigint, every bigint")
        .groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every")),
        "lm-words",
    )
    frequent, every = heavy_words(vocabulary, heavy)
    own = sc.broadcast((frequent.hashes, frequent.counts))

    def heavy_() -> Heavy:
        return Heavy(*own.value, frequent_tokens, frequent_words)

    frequent_tokens, frequent_words = frequent.tokens, frequent.words
    del frequent
    texts = docs.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text"), F.lit(every // slice_tokens + 1)))
    block_bits = max(4, (2 * every // BLOCK_TOKENS).bit_length())
    levels, weights = gram_levels(texts.select("slice", "held", "text"), heavy_, block_bits)
    scored = written(
        texts.groupBy("slice").cogroup(levels.groupBy("slice")).applyInArrow(
            _score(heavy_, weights),
            "row bigint, doc_id bigint, held boolean, n_tokens bigint, known bigint, base double, score double,"
            " word array<bigint>, times array<bigint>",
        ),
        "lm-scores",
    )
    rare = scored.select("row", F.explode(F.arrays_zip("word", "times")).alias("r")).select("row", "r.word", "r.times")
    space = frequent_tokens + 0.5 * (frequent_words + 1)
    counts = vocabulary.select("word", F.log10((F.col("train") + 0.5) / space).alias("log"), (F.col("train") > 0).alias("seen"))
    rest = rare.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.col("log")).alias("more"), F.sum(F.when(F.col("seen"), F.col("times"))).alias("more_known")
    )
    nothing = F.lit(0).cast("bigint")
    return scored.drop("word", "times").join(rest, "row", "left").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", nothing)).alias("n_known"),
        F.lit(frequent_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
