"""Collocations counted over a prefix-free parse of the corpus.

Texts are cut into pieces at punctuation and line ends, and pieces into
words. A piece is then parsed: a pair of neighbouring words whose hash is a
multiple of ``EVERY`` ends a chunk, and the next chunk starts with that same
pair. Where chunks end depends on their words alone, so repeated passages
give the same chunks wherever they stand, and Spark sums them up to a
dictionary: (lang, chunk, parse frequency). A chunk that ends its piece is
marked and another one than the same words inside a piece.

Phrases are counted inside the distinct chunks, weighted by the parse
frequency. Neighbouring chunks share two words; a chunk counts the phrases
that start before its last two words, and the chunk that ends the piece
counts all that are left. So each occurrence of up to three words is counted
once, in the chunk that holds all of it.

Counting moves little: a batch of chunks sorts its phrases by number, sums
the weights, and sends each bucket of phrases (by hash) as one compressed
block of sorted text. A bucket's task merges its blocks, keeps the phrases
that occur ``LEAST`` times, and adds up its share of the words of each
language. The number of buckets follows the bytes of the input, so a
bucket's size does not; a phrase of any frequency is one entry a block.

Scores, the rule against parts of longer phrases and the first ``TOP`` of
each language are joins and windows over the frequent phrases, ranked in
shares first.

Defined results: null text is empty and gives nothing; a null language
counts as ``und``, together with that very name; repeated rows count each
time; an empty table gives no rows; only text and lang are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import written
from plantlens.llm.text import raw, slices

LEAST, TOP, SHARE = 10, 2000, 50
EVERY = 8
OVERLAP = 2  # words that neighbouring chunks share: one less than the longest phrase
UNKNOWN = "und"
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20  # of input text a bucket
SHARE_ROWS = 1 << 18  # candidates that one task ranks
CODEC = "zstd"

# A-Z to a-z, tab to a blank, the signs between pieces to a full stop.
BETWEEN = b".,;:!?\n\x0b\x0c\r"
BYTES = bytes(
    c + 32 if 65 <= c <= 90 else 46 if c in BETWEEN else 32 if c == 9 else c for c in range(256)
)
STOP = b"."  # no word holds one


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of the texts in order, with a STOP after each piece."""
    return (b".".join(texts).translate(BYTES) + STOP).replace(b".", b" . ").split()


class Words:
    """Tokens as numbers in the order of the words' bytes. ``names`` and
    ``hashes`` by number, ``ids`` and ``word`` (whether it is one) by token."""

    def __init__(self, found: list[bytes]):
        self.found = pa.array(found, pa.binary())
        coded = self.found.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        self.names = coded.dictionary.take(order)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        self.ids = rank[coded.indices.to_numpy()]
        stop = pc.index(self.names, pa.scalar(STOP, pa.binary())).as_py()
        self.word = self.ids != stop
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names.to_pylist()), np.uint64, len(order))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    out = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9))
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


# --- the parse --------------------------------------------------------------------


def chunks(found: list[bytes], every: int = EVERY) -> Counter[bytes]:
    """Occurrences of the chunks of tokens; a chunk that ends its piece has
    its STOP behind it."""
    own = Words(found)
    word, h = own.word, own.hashes[own.ids]
    start = np.flatnonzero(word & ~np.r_[False, word[:-1]])
    stop = np.flatnonzero(word & ~np.r_[word[1:], False])
    ends = np.r_[False, (mixed(h[:-1], h[1:]) % np.uint64(every) == 0) & word[:-1] & word[1:]]
    ends[start + 1] = False  # such a chunk would own no phrase
    ends[stop] = False  # the piece's own end
    cut = np.flatnonzero(ends)
    first, last = np.sort(np.r_[start, cut - 1]), np.sort(np.r_[stop, cut])
    last += ~ends[last]  # the STOP
    at = np.r_[0, np.cumsum(pc.binary_length(own.found).to_numpy().astype(np.int64) + 1)]
    text = b" ".join(found)
    return Counter([text[a:b] for a, b in zip(at[first].tolist(), (at[last + 1] - 1).tolist())])


def _parse(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), raw(batch.column("text"))):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                own = chunks(tokens(texts), every)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(list(own), pa.binary()).cast(pa.string()),
                        pa.array(list(own.values()), pa.int64()),
                    ],
                    ["lang", "chunk", "n"],
                )

    return run


def dictionary(documents: DataFrame, every: int = EVERY) -> DataFrame:
    """(lang, chunk, n): the distinct chunks and how often the parse has
    each."""
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    parsed = docs.mapInArrow(_parse(every), "lang string, chunk string, n bigint")
    return parsed.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


# --- phrases of the chunks --------------------------------------------------------


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about SLICE_BYTES of chunks."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column("chunk").nbytes
        if size >= SLICE_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def distinct(columns: list[np.ndarray], count: np.ndarray, names: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns, ascending, with the sums of their
    counts; values are below ``names``."""
    bits = max(1, (names - 1).bit_length())
    if bits * len(columns) <= 63:
        key = columns[0]
        for c in columns[1:]:
            key = (key << bits) | c
        order = np.argsort(key)
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort(columns[::-1])
        new = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    first = np.flatnonzero(np.r_[True, new])
    return [c[order[first]] for c in columns], np.add.reduceat(count[order], first)


def phrases(texts: list[bytes], n: np.ndarray) -> tuple[Words, list]:
    """Words of the chunks, and per length (numbers of the words, count) of
    the distinct phrases that the chunks own."""
    own = Words(b" . ".join(texts).split())  # STOPs of pieces and between chunks
    ids, word = own.ids, own.word
    begin = word & ~np.r_[False, word[:-1]]
    chunk = np.cumsum(begin) - 1
    last = np.flatnonzero(word & ~np.r_[word[1:], False])[np.maximum(chunk, 0)]
    final = np.fromiter((t.endswith(STOP) for t in texts), bool, len(texts))
    place = np.arange(len(ids))
    at = np.flatnonzero(word & (final[np.maximum(chunk, 0)] | (place <= last - OVERLAP)))
    weight, room = n[chunk[at]], last[at] - at
    out = []
    for size in (1, 2, 3):
        fits = room >= size - 1
        some = at[fits]
        if len(some):
            out.append(distinct([ids[some + k] for k in range(size)], weight[fits], len(own.names)))
    return own, out


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches):
            for lang in pc.unique(table.column("lang")).to_pylist():
                own = table.filter(pc.equal(table.column("lang"), lang))
                yield from _blocks(lang, own, buckets)

    return run


def _blocks(lang: str, own: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    words, found = phrases(raw(own.column("chunk").combine_chunks()), own.column("n").to_numpy())
    large = pa.large_binary()
    word = words.names.cast(large)
    ending = pc.binary_join_element_wise(word, pa.scalar(b"\n", large), pa.scalar(b"", large))
    rows = []
    for columns, n in found:
        h = words.hashes[columns[0]]
        for c in columns[1:]:
            h = mixed(h, words.hashes[c])
        bucket = (mixed(h, h) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # sorted text inside a bucket
        bucket, n = bucket[order], n[order]
        parts = [word.take(pa.array(c[order])) for c in columns[:-1]] + [ending.take(pa.array(columns[-1][order]))]
        lines = pc.binary_join_element_wise(*parts, pa.scalar(b" ", large))
        at, text = np.frombuffer(lines.buffers()[1], np.int64), lines.buffers()[2]
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for a, b in pairwise(cuts):
            block = text.slice(int(at[a]), int(at[b] - at[a]))
            counts = n[a:b].tobytes()
            rows.append((
                int(bucket[a]), lang, len(columns), block.size, b - a,
                pa.compress(block, CODEC, asbytes=True), pa.compress(counts, CODEC, asbytes=True),
            ))
    for start in range(0, len(rows), 1000):
        columns = list(zip(*rows[start : start + 1000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCKS)], schema=BLOCKS)


BLOCKS = pa.schema([
    ("bucket", pa.int64()), ("lang", pa.string()), ("words", pa.int32()), ("bytes", pa.int64()),
    ("lines", pa.int64()), ("text", pa.binary()), ("counts", pa.binary()),
])
BLOCKS_SQL = "bucket bigint, lang string, words int, bytes bigint, lines bigint, text binary, counts binary"
FREQUENT = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64())])
FREQUENT_SQL = "lang string, phrase string, words int, a bigint"


def unpacked(text: bytes, size: int, counts: bytes, lines: int) -> tuple[pa.Array, np.ndarray]:
    """The lines of a block, with their ends, and their counts."""
    data = pa.decompress(text, size, CODEC)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    offsets = pa.py_buffer(np.r_[0, ends].astype(np.int64))
    own = np.frombuffer(pa.decompress(counts, 8 * lines, CODEC), np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), lines, [None, offsets, data]), own


def _merge(least: int):
    def run(table: pa.Table) -> pa.Table:
        parts: dict[tuple[str, int], list] = {}
        for row in table.select(["lang", "words", "bytes", "lines", "text", "counts"]).to_pylist():
            block = unpacked(row["text"], row["bytes"], row["counts"], row["lines"])
            parts.setdefault((row["lang"], row["words"]), []).append(block)
        out = []
        for (lang, words), blocks in parts.items():
            count = np.concatenate([n for _, n in blocks])
            if words == 1:
                out.append(pa.table([[lang], [None], [0], [int(count.sum())]], schema=FREQUENT))
            coded = pa.chunked_array([p for p, _ in blocks]).combine_chunks().dictionary_encode()
            total = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(total, coded.indices.to_numpy(), count)
            often = np.flatnonzero(total >= least)
            found = pc.binary_slice(coded.dictionary.take(pa.array(often)), 0, -1)
            found = found.cast(pa.large_string()).cast(pa.string())
            out.append(pa.table([[lang] * len(often), found, [words] * len(often), total[often]], schema=FREQUENT))
        return pa.concat_tables(out)

    return run


def frequent(chunked: DataFrame, buckets: int, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, a): the phrases of 1 to 3 words that occur
    ``least`` times; rows without a phrase add up to the words of a
    language."""
    blocks = chunked.mapInArrow(_count(buckets), BLOCKS_SQL)
    return blocks.groupBy("bucket").applyInArrow(_merge(least), FREQUENT_SQL)


# --- scores -----------------------------------------------------------------------


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the frequent phrases of two
    and three words: the cut with the lowest score, of equals the first.

    Decimals of 16 digits keep a * a * 1000000 and l * r exact.
    """
    own = found.where("words > 0")
    spaces = F.col("words") - 1
    cuts = own.where("words > 1").select(
        "lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), spaces)).alias("k")
    ).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right"),
    )
    left = own.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = own.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    exact = {x: f"cast({x} as decimal(16, 0))" for x in "alr"}
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({exact['a']} * {exact['a']})) div ({exact['l']} * {exact['r']})")
    return (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )


def collocations(
    documents: DataFrame, every: int = EVERY, least: int = LEAST, top: int = TOP, share: int = SHARE,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Per language its first ``top`` phrases: lang, rank, phrase, a, l, r,
    n, score."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = written(frequent(dictionary(documents, every), 1 + size // bucket_bytes, least), "phrases")
    candidates = written(scored(found), "candidates")
    totals = found.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    inside = candidates.where("words = 3").select(
        "lang", F.explode(F.array(F.expr("substring_index(phrase, ' ', 2)"), F.expr("substring_index(phrase, ' ', -2)"))).alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = candidates.join(inside, ["lang", "phrase"], "left").where(
        (F.col("words") == 3) | F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    # The first of each share of a language before the first of all of it:
    # no task ranks more than a share, or the first ``top`` of the shares.
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    shares = 8 + candidates.count() // SHARE_ROWS
    place = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order))
    firsts = alone.withColumn("rank", place).where(F.col("rank") <= top)
    return (
        firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
