"""Benchmark decontamination by an FM-index per shard of documents.

Each task gathers its documents into shards of a bounded number of words,
builds an FM-index of a shard, searches every benchmark window backwards,
locates the occurrences by sampled suffix positions and merges them into
removal spans of word positions. No document is shuffled.

The windows are broadcast in blocks of at most ``block_words`` benchmark
words; a larger benchmark takes one pass over the documents per block.

Defined results: null or empty text has no words and no hits; an item with
null or no words has no window; repeated items and windows count once; an
item with a null id is named "null"; repeated documents are searched one by
one; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.llm.common import shipped, with_text
from plantlens.llm.fm_index import FMIndex
from plantlens.llm.text import ITEM_WORD, item_words, raw

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_WORDS = 1 << 21

SPANS = "array<struct<start: bigint, end: bigint>>"  # of word positions, end exclusive
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Windows:
    """Distinct benchmark windows with the items that hold them."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        held: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, text in items:
            words = item_words(text)
            for at in range(max(min(len(words), 1), len(words) - window + 1)):
                held[tuple(words[at : at + window])].add(item)
        self.window = window
        self.words = {w: i for i, w in enumerate(sorted({w for key in held for w in key}))}
        self.lengths = np.array([len(key) for key in held], dtype=np.int64)
        self.table = np.full((len(held), window), -1, dtype=np.int64)
        for row, key in enumerate(held):
            self.table[row, window - len(key) :] = [self.words[w] for w in key]
        self.items = [sorted(names) for names in held.values()]

    def spans(self, ids: dict[bytes, int], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start positions and window numbers of all occurrences."""
        known = np.array([ids.get(w, 0) for w in self.words], dtype=np.int64)
        patterns = np.where(self.table < 0, 0, known[self.table]) if len(known) else self.table
        used = np.flatnonzero(((patterns > 0) | (self.table < 0)).all(axis=1))
        if not len(used):
            return np.empty(0, dtype=np.int64), used
        index = FMIndex(symbols)
        low, high = index.search(patterns[used], self.lengths[used])
        hits = high - low
        rows = np.repeat(low - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
        return index.locate(rows), np.repeat(used, hits)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    spans: list[list[int]] = []
    for at in np.lexsort((ends, starts)):
        if spans and starts[at] <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], int(ends[at]))
        else:
            spans.append([int(starts[at]), int(ends[at])])
    return [(a, b) for a, b in spans]


class Shard:
    """Word symbols of the documents read so far, to be searched together."""

    def __init__(self, windows: Windows):
        self.windows = windows
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count(1).__next__)
        self.pieces: list[np.ndarray] = []
        self.owners: list[tuple[int, int]] = []  # document, first word
        self.size = 0

    def add(self, document: int, first: int, words: list[bytes]) -> None:
        piece = np.zeros(len(words) + 1, dtype=np.int64)
        piece[:-1] = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        self.pieces.append(piece)
        self.owners.append((document, first))
        self.size += len(piece)

    def search(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Document, starts and window numbers, for each piece with hits."""
        if not self.pieces:
            return
        at, window = self.windows.spans(dict(self.ids), np.concatenate(self.pieces))
        begins = np.cumsum([0] + [len(p) for p in self.pieces[:-1]])
        piece = np.searchsorted(begins, at, side="right") - 1
        order = np.argsort(piece, kind="stable")
        cuts = np.flatnonzero(np.diff(piece[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            document, first = self.owners[piece[part[0]]]
            yield document, at[part] - begins[piece[part[0]]] + first, window[part]


def _found(windows: Windows, rows: int, hits) -> tuple[list, list]:
    """Merged spans and item names of each of ``rows`` documents."""
    starts, ends, names = defaultdict(list), defaultdict(list), defaultdict(set)
    for document, at, window in hits:
        starts[document].append(at)
        ends[document].append(at + windows.lengths[window])
        names[document].update(n for w in np.unique(window) for n in windows.items[w])
    spans = [
        merged(np.concatenate(starts[d]), np.concatenate(ends[d])) if d in starts else [] for d in range(rows)
    ]
    return spans, [names.get(d, set()) for d in range(rows)]


def _long(windows: Windows, shard_words: int, words: list[bytes]):
    """Hits of a document longer than a shard, searched in pieces that
    overlap by a window less one word."""
    for first in range(0, len(words), shard_words):
        shard = Shard(windows)
        shard.add(0, first, words[first : first + shard_words + windows.window - 1])
        yield from shard.search()


def _scan(windows_, shard_words: int):
    """Batches of (row, text, n_words, spans, items): spans and items gain
    what the broadcast windows hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = windows_()
        shard, sizes = Shard(windows), []

        def out(part: pa.RecordBatch, hits) -> pa.RecordBatch:
            spans, names = _found(windows, part.num_rows, hits)
            for d, (before, items) in enumerate(zip(part.column("spans").to_pylist(), part.column("items").to_pylist())):
                if before:
                    every = [(s["start"], s["end"]) for s in before] + spans[d]
                    spans[d] = merged(*(np.array(x) for x in zip(*every)))
                names[d] = sorted(names[d].union(items))
            return pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("text"),
                    pa.array(sizes, pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], ARROW_SPANS),
                    pa.array(names, pa.list_(pa.string())),
                ],
                ["row", "text", "n_words", "spans", "items"],
            )

        for batch in batches:
            first = 0
            for at, text in enumerate(raw(batch.column("text"))):
                words = item_words(text)
                if shard.size and shard.size + len(words) > shard_words:
                    yield out(batch.slice(first, at - first), shard.search())
                    first = at
                    shard.clear()
                    sizes.clear()
                sizes.append(len(words))
                if len(words) > shard_words:
                    yield out(batch.slice(at, 1), _long(windows, shard_words, words))
                    first = at + 1
                    sizes.clear()
                else:
                    shard.add(at - first, 0, words)
            if first < batch.num_rows:
                yield out(batch.slice(first), shard.search())
            shard.clear()
            sizes.clear()

    return run


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between
    them."""
    places = [m.span() for m in ITEM_WORD.finditer(text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) without the words of the spans."""
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        if any(spans):
            cuts = [
                t if t is None or not s else cut(t, [(x["start"], x["end"]) for x in s])
                for t, s in zip(texts.cast(pa.binary()).to_pylist(), spans)
            ]
            texts = pa.array(cuts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "text"])


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """Benchmark items in blocks of a bounded number of words."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    block, size = [], 0
    for row in rows.toLocalIterator():
        words = len(item_words(row.text.encode()))
        if block and size + words > limit:
            yield block
            block, size = [], 0
        block.append((row.item, row.text.encode()))
        size += words
    yield block


def _scanned(
    documents: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, window: int, shard_words: int,
    block_words: int, cut_out: bool = False,
) -> DataFrame:
    """(row, text, n_words, spans, items) of ``documents`` (row, text), over
    all blocks of the benchmark; or (row, text) with the spans cut out. One
    worker takes a batch through all of it."""
    found = documents.select(
        "row", "text", F.lit(0).cast("bigint").alias("n_words"), F.lit(None).cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    steps = [
        _scan(shipped(documents.sparkSession, Windows(block, window)), shard_words)
        for block in _blocks(benchmark, item_col, text_col, block_words)
    ]
    if cut_out:
        steps.append(_cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return found.mapInArrow(run, documents.schema if cut_out else found.schema)


def contamination(
    documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", window: int = WINDOW, shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: doc_id, n_words, spans (merged [start, end) word
    positions inside occurring windows) and items (their ids, sorted)."""
    rows = documents.select(F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.col(text_col).alias("text"))
    found = _scanned(rows, benchmark, item_col, text_col, window, shard_words, block_words)
    return found.select("row.doc_id", "n_words", "spans", "items")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns of ``contamination``."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``documents`` with the removal spans of all blocks cut out of their
    texts at once; no document is dropped. A column n_chars follows its
    text."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c != text_col]
    rows = documents.select(F.struct(*(rest or [F.lit(0)])).alias("row"), F.col(text_col).alias("text"))
    clean = _scanned(rows, benchmark, item_col, text_col, window, shard_words, block_words, cut_out=True)
    return with_text(clean, documents.columns, text_col)
