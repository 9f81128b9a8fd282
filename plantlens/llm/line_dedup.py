"""Reversible line dedup: sharded cuckoo filters over exact reference
counts.

A line's key is the line stripped at both ends and A-Z lower-cased; keys
travel as 128-bit hashes. A key held by two or more documents is *shared*:
it loses its lines in every document but the one with the smallest id.

``references`` is a log of (key, document, +1 or -1); their sums are the
exact counts. A cuckoo filter per shard of the key space holds the shared
keys. Nearly all lines are settled by a negative probe; only positive
probes are joined with the exact table. Filters take deletions, so both
sides follow when documents come (``insert``) or go (``delete``).

Filters are broadcast in groups of at most ``GROUP_BYTES``, one pass of
probes per group.

Defined results: null text is one empty line and stays null; a null id sorts after all
others, and rows of one id are one document; each row gets its result;
columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import shipped, with_text, written
from plantlens.llm.text import raw, slices

MIN_CHARS = 10
SHARD_KEYS = 50_000
GROUP_BYTES = 64 << 20
BLANKS = b" \t\n\x0b\x0c\r"
SLOTS = 4


def keys(text: bytes) -> list[bytes | None]:
    """128-bit key of each line; None where it is too short to count."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(BLANKS)
        # UTF-8 takes at most four bytes a character.
        wide = len(key) >= MIN_CHARS and (len(key) >= 4 * MIN_CHARS or len(key.decode()) >= MIN_CHARS)
        out.append(xxhash.xxh3_128_digest(key.lower()) if wide else None)
    return out


def _order(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(2**63 - 1))


def references(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", filters_=None) -> DataFrame:
    """Distinct (k1, k2, doc) of the documents' countable lines; doc is the
    id, the largest bigint for null. With broadcast filters, only keys that
    may be in them; the lines are probed by the worker that splits them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters | None = filters_ and filters_()
        for batch in slices(batches):
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                own = {k for k in keys(text) if k}
                found += own
                ids += [doc] * len(own)
            pairs = _key_batch(found, {"doc": pa.array(ids, pa.int64())})
            if filters:
                k1, k2 = (pairs.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                pairs = pairs.filter(pa.array(filters.holds(k1, k2)))
            yield pairs

    lines = documents.select(_order(id_col).alias("doc"), F.col(text_col).alias("text"))
    return lines.mapInArrow(run, "k1 bigint, k2 bigint, doc bigint")


def _key_batch(found: list[bytes], more: dict[str, pa.Array]) -> pa.RecordBatch:
    pairs = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"k1": pa.array(pairs[:, 0]), "k2": pa.array(pairs[:, 1])} | more)


# --- cuckoo filters -------------------------------------------------------------


def _fingerprints(k1: np.ndarray) -> np.ndarray:
    """16-bit fingerprints, never 0."""
    return (k1 >> 48) & 0xFFFF | 1


def _spread(fingerprint):
    """Distance between the two buckets of a fingerprint."""
    return (fingerprint * 0x5BD1E995) >> 7


class Cuckoo:
    """A cuckoo filter with four slots a bucket. It grows by a rebuild from
    the exact keys."""

    def __init__(self, buckets: int, table: bytes | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else (
            np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy()
        )

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> Cuckoo:
        buckets = 1 << max(2, int(len(k1) / SLOTS / 0.8).bit_length())
        while True:
            made = cls(buckets)
            if all(made.insert(a, b) for a, b in zip(*made.places(k1, k2))):
                return made
            buckets *= 2

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[list[int], list[int]]:
        return _fingerprints(k1).tolist(), (k2 & (self.buckets - 1)).tolist()

    def insert(self, fingerprint: int, bucket: int) -> bool:
        table, mask, step = self.table, self.buckets - 1, _spread(fingerprint)
        for at in (bucket, (bucket ^ step) & mask):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = fingerprint
                return True
        at = bucket
        for kick in range(500):
            slot = kick % SLOTS
            fingerprint, table[at, slot] = int(table[at, slot]), fingerprint
            at = (at ^ _spread(fingerprint)) & mask
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = fingerprint
                return True
        return False

    def delete(self, fingerprint: int, bucket: int) -> bool:
        for at in (bucket, (bucket ^ _spread(fingerprint)) & (self.buckets - 1)):
            held = np.flatnonzero(self.table[at] == fingerprint)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False


class Filters:
    """The filters of a range of shards, probed together."""

    def __init__(self, shards: int, rows: list):
        self.shards = shards
        self.buckets = np.zeros(shards, np.int64)
        self.offset = np.zeros(shards, np.int64)
        tables, at = [np.zeros((1, SLOTS), np.uint16)], 1
        for row in rows:
            self.buckets[row.shard], self.offset[row.shard] = row.buckets, at
            tables.append(np.frombuffer(bytes(row.cells), np.uint16).reshape(-1, SLOTS))
            at += row.buckets
        self.table = np.concatenate(tables)

    def holds(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Whether each key may be shared; False is certain."""
        shard = _shard(k1, self.shards)
        mask, offset = np.maximum(self.buckets[shard] - 1, 0), self.offset[shard]
        fingerprint = _fingerprints(k1)
        first = k2 & mask
        second = (first ^ _spread(fingerprint)) & mask
        both = (self.table[offset + first] == fingerprint[:, None]) | (
            self.table[offset + second] == fingerprint[:, None]
        )
        return both.any(axis=1) & (self.buckets[shard] > 0)


def _shard(k1: np.ndarray, shards: int) -> np.ndarray:
    return k1 & (shards - 1)


# --- the index -------------------------------------------------------------------


@dataclass
class LineIndex:
    """References, shared keys and their filters as written tables."""

    log: DataFrame  # k1, k2, doc, delta
    shared: DataFrame  # k1, k2, n, keeper
    filters: DataFrame  # shard, buckets, cells
    shards: int

    @classmethod
    def build(cls, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        log = written(references(documents, id_col, text_col).withColumn("delta", F.lit(1)), "line-references")
        shared = written(_shared(log), "line-shared")
        shards = 1 << max(0, (shared.count() // SHARD_KEYS).bit_length())
        filters = written(
            shared.select("k1", "k2", F.col("k1").bitwiseAND(shards - 1).cast("int").alias("shard"))
            .groupBy("shard")
            .applyInPandas(_build_filter, "shard int, buckets bigint, cells binary"),
            "line-filters",
        )
        return cls(log, shared, filters, shards)

    def insert(self, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with more documents. An id that is already live must be
        deleted first."""
        return self._changed(references(documents, id_col, text_col).withColumn("delta", F.lit(1)))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (column doc_id)."""
        gone = ids.select(_order("doc_id").alias("doc")).distinct()
        live = self.log.groupBy("k1", "k2", "doc").agg(F.sum("delta").alias("live")).where("live > 0")
        return self._changed(
            live.join(gone, "doc", "left_semi").select("k1", "k2", "doc", F.lit(-1).alias("delta"))
        )

    def _changed(self, change: DataFrame) -> LineIndex:
        change = written(change.select("k1", "k2", "doc", "delta"), "line-change")
        log = self.log.unionByName(change)
        touched = change.select("k1", "k2").distinct()
        now = written(_shared(log.join(touched, ["k1", "k2"], "left_semi")), "line-shared")
        shared = written(
            self.shared.join(touched, ["k1", "k2"], "left_anti").unionByName(now), "line-shared"
        )
        # Keys that began or ceased to be shared move in and out of filters.
        before = self.shared.join(touched, ["k1", "k2"], "left_semi").select("k1", "k2", F.lit(-1).alias("step"))
        moves = (
            now.select("k1", "k2", F.lit(1).alias("step")).unionByName(before)
            .groupBy("k1", "k2").agg(F.sum("step").alias("step")).where("step <> 0")
            .withColumn("shard", F.col("k1").bitwiseAND(self.shards - 1).cast("int"))
        )
        moved = written(
            self.filters.groupBy("shard").cogroup(moves.groupBy("shard"))
            .applyInPandas(_move, self.filters.schema), "line-filters",
        )
        full = moved.where("buckets < 0").select("shard")
        again = (
            shared.withColumn("shard", F.col("k1").bitwiseAND(self.shards - 1).cast("int"))
            .join(full, "shard", "left_semi").select("k1", "k2", "shard")
            .groupBy("shard").applyInPandas(_build_filter, self.filters.schema)
        )
        filters = written(moved.where("buckets >= 0").unionByName(again), "line-filters")
        return LineIndex(log, shared, filters, self.shards)

    def _groups(self) -> Iterator[Filters]:
        """Filters in groups of bounded size."""
        rows, size = [], 0
        for row in self.filters.toLocalIterator():
            if rows and size + len(row.cells) > GROUP_BYTES:
                yield Filters(self.shards, rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row.cells)
        yield Filters(self.shards, rows)

    def drops(self, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Per document with drops: doc and the keys of its dropped lines."""
        spark = documents.sparkSession
        maybe = None
        for group in self._groups():
            held = references(documents, id_col, text_col, shipped(spark, group))
            maybe = held if maybe is None else maybe.unionByName(held)
        lost = maybe.distinct().join(self.shared, ["k1", "k2"]).where("doc <> keeper")
        return lost.groupBy("doc").agg(F.collect_list(F.struct("k1", "k2")).alias("lost"))

    def apply(self, documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(row, text, n_lines, n_dropped): each document's other columns,
        its text without dropped lines, and the counts."""
        rest = [F.col(f"`{c}`") for c in documents.columns if c != text_col]
        rows = documents.select(
            F.struct(*rest).alias("row"), F.col(text_col).alias("text"), _order(id_col).alias("doc")
        )
        joined = rows.join(self.drops(documents, id_col, text_col), "doc", "left").select("row", "text", "lost")
        schema = rows.select("row", "text").schema.add("n_lines", T.LongType()).add("n_dropped", T.LongType())
        return joined.mapInArrow(_strip, schema)


def _shared(log: DataFrame) -> DataFrame:
    """Keys with two or more live documents, and the smallest of them."""
    live = log.groupBy("k1", "k2", "doc").agg(F.sum("delta").alias("live")).where("live > 0")
    counts = live.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("doc").alias("keeper"))
    return counts.where("n >= 2")


def _build_filter(rows: pd.DataFrame) -> pd.DataFrame:
    made = Cuckoo.of(rows.k1.to_numpy(), rows.k2.to_numpy())
    return pd.DataFrame(
        {"shard": [rows.shard.iloc[0]], "buckets": [made.buckets], "cells": [made.table.tobytes()]}
    )


def _move(filters: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after its moves; buckets is -1 where it is full and
    must be built again from the exact keys."""
    if filters.empty:
        return _build_filter(moves[moves.step > 0])
    made = Cuckoo(int(filters.buckets.iloc[0]), filters.cells.iloc[0])
    room = True
    for step in (-1, 1):
        part = moves[moves.step == step]
        change = made.delete if step < 0 else made.insert
        for place in zip(*made.places(part.k1.to_numpy(), part.k2.to_numpy())):
            room &= change(*place)
    return pd.DataFrame(
        {"shard": [filters.shard.iloc[0]], "buckets": [made.buckets if room else -1], "cells": [made.table.tobytes()]}
    )


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts, lines, dropped = [], [], []
        null = batch.column("text").is_null().to_pylist()
        lost = batch.column("lost").to_pylist()
        for text, gone, absent in zip(raw(batch.column("text")), lost, null):
            every = text.split(b"\n")
            lines.append(len(every))
            if gone:
                gone = {np.array([g["k1"], g["k2"]], "<i8").tobytes() for g in gone}
                every = [line for line, key in zip(every, keys(text)) if key not in gone]
                text = b"\n".join(every)
            dropped.append(lines[-1] - len(every))
            texts.append(None if absent else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(lines, pa.int64()),
                pa.array(dropped, pa.int64()),
            ],
            ["row", "text", "n_lines", "n_dropped"],
        )


def digest(documents: DataFrame) -> DataFrame:
    """The query's columns: n_lines, n_dropped and the hash of what stays."""
    docs = documents.select("doc_id", "text")
    kept = LineIndex.build(docs).apply(docs)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with shared lines cut from all but their first
    document; no document is dropped."""
    kept = LineIndex.build(documents).apply(documents)
    return with_text(kept, documents.columns, "text")
