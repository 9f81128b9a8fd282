"""N-gram Jaccard join by vertical partitioning.

A global order of all n-grams is cut into fragments. Every document's
n-grams, laid out in that order, fall into segments, one per fragment; a
pair's overlap is counted in each fragment by itself and the counts are
summed per pair.

The order puts rare n-grams first. Its frequencies come from a sketch of
fixed size that counts the documents of every n-gram, hashed into buckets;
the order of the buckets is broadcast (8 bytes times ``BUCKETS``). Any order
gives right results, a good one gives few candidates: documents can only
link if they share an n-gram among the first n - ceil(t n) + 1 of each.

A node of the join is a document with its set: the id and the first 64 bits
of the set's key, exclusive or. Rows without an id, or with the same one,
are one node only if their sets are equal.

Equal sets are one class, joined through its smallest document. A group of
classes that share a leading n-gram is not paired off: first every member is
checked against the group's smallest one, then, in ``TURNS`` turns, against
``PIVOTS`` others drawn by hash, and only members that are still in
different components are paired in the end, a large group in parts. Links
inside a component that is already connected are not looked for; the
components are those of all links.

A pair is looked for in the group of its first common n-gram in the global
order: what it shares lies from there on in both. Before n-grams are
counted, two more bounds drop pairs that cannot link: the leading n-grams
that two documents share, and a bitmap of each whole set. All bound the
overlap from above, so no link is lost. Members that no other one of their
group can link with by these bounds leave it after the first check, so that
the turns do not carry rows that merely share an n-gram.

Defined results: null or empty text has an empty set and is its own
component; each row gets its result by its own text, rows of one id with
different texts too; a null id sorts after all others and gets component_id
null unless it links with an id; columns other than the id and the text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.llm.common import shipped, written
from plantlens.llm.components import components
from plantlens.llm.id_filter import id_filter, passing, places
from plantlens.llm.text import raw, slices

BUCKET_BITS = 21
BUCKETS = 1 << BUCKET_BITS
BLOCK = 1 << 14
FRAGMENTS = 8
PIECE = 1 << 16  # bytes of text whose words are hashed at once
BLANKS = b" \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C13
BITMAP = 512
TURNS = 2
PIVOTS = 4
PART = 512  # members of a group that one task pairs with all others
NO_ID = 2**63 - 1
KEYS = "doc bigint, k1 bigint, k2 bigint, n bigint"


class Grams:
    """Sorted distinct n-gram hashes of texts. A word's hash is a polynomial
    in ``BASE`` of the hashes of its bytes, A-Z as a-z; all words of a piece
    of text are hashed at once."""

    def __init__(self, n: int):
        self.n = n
        self.value = np.array([xxhash.xxh3_64_intdigest(bytes([c]).lower()) for c in range(256)], np.uint64)
        self.value[list(BLANKS)] = 0
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a text that starts with a blank start, and
        their hashes."""
        chars = np.frombuffer(text, np.uint8)
        inside = (self.value != 0)[chars]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(chars) + PIECE, PIECE)))
        parts = []
        for i, j in zip(cuts, cuts[1:]):
            own = chars[starts[i] : starts[j] if j < len(starts) else len(chars)]
            if len(own) > len(self.power):
                size = max(len(own), PIECE)
                self.power, self.inverse = (
                    np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)])
                    for x in (BASE, pow(BASE, -1, 2**64))
                )
            at = starts[i:j] - starts[i]
            parts.append(np.add.reduceat(self.value[own] * self.power[: len(own)], at) * self.inverse[at])
        found = np.concatenate([*parts, np.empty(0, np.uint64)])
        found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return starts, found ^ (found >> np.uint64(32))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        starts, each = self.words(b" ".join([b"", *texts]))
        begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
        first = np.searchsorted(starts, begins).tolist()
        count = max(len(each) - self.n + 1, 0)
        mixed = each[:count]
        for k in range(1, self.n):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed += each[k : count + k]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(29)
        return [self._set(each[i:j], mixed[i : max(j - self.n + 1, i)]) for i, j in zip(first, first[1:])]

    def _set(self, words: np.ndarray, grams: np.ndarray) -> np.ndarray:
        if len(grams):
            grams = np.sort(grams)
            return grams[np.concatenate([[True], grams[1:] != grams[:-1]])]
        if len(words):
            return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), seed=1)], np.uint64)
        return np.empty(0, np.uint64)


def bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


# --- the global order -------------------------------------------------------------


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(n), np.zeros(BUCKETS, np.uint32)
        for batch in slices(batches):
            sets = grams.sets(raw(batch.column("text")))
            if sets:
                np.add.at(total, bucket(np.concatenate(sets)), np.uint32(1))
        for block in range(BUCKETS // BLOCK):
            part = total[block * BLOCK : (block + 1) * BLOCK]
            used = np.flatnonzero(part)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "places": pa.array([used.astype(np.uint16).tobytes()], pa.binary()),
                    "counts": pa.array([part[used].tobytes()], pa.binary()),
                }
            )

    return run


def _add(parts: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, np.int64)
    for places, counts in zip(parts.column("places").to_pylist(), parts.column("counts").to_pylist()):
        total[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint32)
    block = pa.array([parts.column("block")[0].as_py()], pa.int32())
    return pa.table({"block": block, "counts": pa.array([total.tobytes()], pa.binary())})


class Order:
    """The n-grams by frequency class of their bucket, bucket and hash, and
    the fragments this order is cut into."""

    def __init__(self, counts: np.ndarray, fragments: int):
        level = np.frexp(counts.astype(np.float64))[1]
        by_rank = np.argsort(level, kind="stable")
        self.rank = np.empty(len(counts), np.uint32)
        self.rank[by_rank] = np.arange(len(counts), dtype=np.uint32)
        load = np.cumsum(counts[by_rank])
        self.pivots = np.searchsorted(load, load[-1] * np.arange(1, fragments) / fragments)

    @classmethod
    def over(cls, docs: DataFrame, n: int, fragments: int) -> Order:
        parts = docs.select("text").mapInArrow(_sketch(n), "block int, places binary, counts binary")
        summed = parts.groupBy("block").applyInArrow(_add, "block int, counts binary")
        counts = np.zeros(BUCKETS, np.int64)
        for row in summed.collect():  # BUCKETS counts in all
            counts[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.counts, np.int64)
        return cls(counts, fragments)

    def sort(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams in order, with their buckets' ranks."""
        rank = self.rank[bucket(grams)]
        by_rank = np.argsort(rank, kind="stable")
        return grams[by_rank], rank[by_rank]

    def fragment(self, ranks: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.pivots, ranks, side="right")


# --- sets, leading n-grams and segments ---------------------------------------------


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Two words of 64 bits for each set."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), "<i8").reshape(-1, 2)


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Which of BITMAP hash cells hold an odd number of the n-grams, as words
    of 64 bits. Two sets differ in at least as many n-grams as their bitmaps
    differ in cells."""
    cells = np.bincount((grams & np.uint64(BITMAP - 1)).astype(np.int64), minlength=BITMAP)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _nodes(batch: pa.RecordBatch, sets: list[np.ndarray]) -> pa.Array:
    return pa.array(set_keys(sets)[:, 0] ^ batch.column("doc").to_numpy())


def _again(repeated: np.ndarray, batch: pa.RecordBatch) -> pa.Array:
    """Whether another row may have the same node: its id is in the filter
    of repeated ids."""
    return pa.array(passing(repeated, batch.column("places")))


def _keys(n: int, *keep: str):
    """Per document: set key and size, and the columns to keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(n)
        for batch in slices(batches):
            own = grams.sets(raw(batch.column("text")))
            keys = set_keys(own)
            sizes = pa.array([len(x) for x in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), sizes, *map(batch.column, keep)],
                ["doc", "k1", "k2", "n", *keep],
            )

    return run


def _leads(order_, wanted_, repeated_, n: int, percent: int):
    """Per document that passes the filter of wanted ids: node, set size,
    bitmap and the leading n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, grams, wanted, repeated = order_(), Grams(n), wanted_(), repeated_()
        for batch in slices(batches):
            batch = batch.filter(pa.array(passing(wanted, batch.column("places"))))
            sets = grams.sets(raw(batch.column("text")))
            sizes = [len(x) for x in sets]
            lead = [order.sort(x)[0][: len(x) - -(-percent * len(x) // 100) + 1] for x in sets]
            flat = np.concatenate([*lead, np.empty(0, np.uint64)]).view(np.int64)
            offsets = pa.array(np.cumsum([0] + [len(x) for x in lead]), pa.int32())
            bits = np.concatenate([*map(bitmap, sets), np.empty(0, np.int64)])
            words = pa.array(np.arange(len(sets) + 1) * (BITMAP // 64), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    _nodes(batch, sets), batch.column("doc"), _again(repeated, batch), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(words, pa.array(bits)),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                ],
                ["doc", "id", "again", "n", "bits", "lead"],
            )

    return run


def _segments(order_, wanted_, repeated_, n: int):
    """Per document that passes the filter of wanted ids, and fragment: its
    node and n-grams there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, grams, wanted, repeated = order_(), Grams(n), wanted_(), repeated_()
        for batch in slices(batches):
            batch = batch.filter(pa.array(passing(wanted, batch.column("places"))))
            sets = grams.sets(raw(batch.column("text")))
            docs, again, fragments, parts = [], [], [], []
            for node, more, own in zip(_nodes(batch, sets).to_pylist(), _again(repeated, batch).to_pylist(), sets):
                own, ranks = order.sort(own)
                number = order.fragment(ranks)
                cuts = np.flatnonzero(np.diff(number)) + 1
                for part, first in zip(np.split(own, cuts), [0, *cuts] if len(own) else []):
                    docs.append(node)
                    again.append(more)
                    fragments.append(int(number[first]))
                    parts.append(part)
            flat = np.concatenate([*parts, np.empty(0, np.uint64)]).view(np.int64)
            offsets = np.cumsum([0] + [len(x) for x in parts])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()), pa.array(again, pa.bool_()), pa.array(fragments, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                ["doc", "again", "fragment", "grams"],
            )

    return run


# --- the join -------------------------------------------------------------------------


def _packed(rows: DataFrame, label: str) -> DataFrame:
    """The little that tasks made of their texts, written in as many files as
    its size asks for instead of one a task: without Hadoop's native library
    an executor starts a process or more for every file."""
    return written(rows.hint("rebalance", "doc"), label)


def _once(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of the same node once. Only rows of repeated ids are shuffled."""
    return rows.where("not again").unionByName(rows.where("again").dropDuplicates(list(keys))).drop("again")


def _linked(overlap: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (F.col("na") + F.col("nb") - overlap)


def _possible(percent: int) -> Column:
    """Whether a pair that shares an n-gram at positions pa and pb can link,
    if that is its first common one: by length, by the n-grams from there on,
    and by the leading ones among them that others have too."""
    length = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    leading = F.least("latera", "laterb") + _after_leads(percent)
    return length & _linked(F.least(rest, leading), percent)


def _after_leads(percent: int) -> Column:
    """The most n-grams that a pair can share after the leading ones of the
    document where these end earlier in the global order."""
    return F.greatest(*(F.ceil(percent * F.col(n) / 100) - 1 for n in ("na", "nb")))


def _digest(gram: Column) -> Column:
    return gram.bitwiseAND(0x7FFFFFFF).cast("int")


def _facts(lead: DataFrame, groups: DataFrame) -> DataFrame:
    """Per document in a group: doc, n, bits, the digests of its leading
    n-grams that others have too, and how many of these digests coincide."""
    own = groups.groupBy("doc").agg(F.collect_list(_digest(F.col("gram"))).alias("digests"))
    lost = F.size("digests") - F.size(F.array_distinct("digests"))
    return lead.select("doc", "n", "bits").join(own, "doc").withColumn("lost", lost)


def _by_bitmap(percent: int) -> Column:
    """Whether a pair can link by its bitmaps."""
    apart = sum(F.bit_count(F.col("bitsa")[k].bitwiseXOR(F.col("bitsb")[k])) for k in range(BITMAP // 64))
    return _linked((F.col("na") + F.col("nb") - apart) / 2, percent)


def _by_leads(percent: int) -> Column:
    """Whether a pair can link by its leading n-grams. Of the two documents,
    the one whose leading n-grams end earlier in the global order can share
    beyond them only its n-grams after them."""
    common = F.size(F.array_intersect("digestsa", "digestsb")) + F.col("losta") + F.col("lostb")
    return _linked(common + _after_leads(percent), percent)


def _side(rows: DataFrame, end: str) -> DataFrame:
    """``rows`` as one side of a pair: the document is a or b."""
    names = {c: c + end for c in rows.columns if c not in ("gram", "part", "doc", "pos")}
    return rows.withColumnsRenamed(names | {"doc": end, "pos": "p" + end})


def _likely(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can link, with na and nb."""
    both = pairs.join(_side(facts, "a"), "a").join(_side(facts, "b"), "b")
    return both.where(_by_bitmap(percent) & _by_leads(percent)).select("a", "b", "na", "nb")


def _with_match(rows: DataFrame, may: Column) -> DataFrame:
    """The rows of groups that ``may`` link with another one of their group."""
    one, two = (_side(rows, x).withColumnRenamed("gram", f"gram{x}") for x in "ab")
    same = (F.col("grama") == F.col("gramb")) & (F.col("a") != F.col("b"))
    return one.join(two, same & may, "left_semi").toDF(*rows.columns)


def _matched(groups: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The members of groups, but their heads, that can link with another
    one by all bounds. Members of groups of more than PART stay untested."""
    own = ("gram", "doc", "n", "pos", "later")
    rest = groups.where("doc <> head and members > 2").select(*own, "members")
    small = _with_match(rest.where(F.col("members") <= PART).select(*own), _possible(percent))
    small = written(small.join(facts.drop("n"), "doc"), "gram-match")
    matched = _with_match(small, _possible(percent) & _by_bitmap(percent) & _by_leads(percent))
    large = rest.where(F.col("members") > PART)
    return written(matched.select(*own).unionByName(large.select(*own)), "gram-rest")


def _unlike(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of groups with members in different components, with their
    labels and the group's size."""
    placed = rest.select("gram", "doc", "n", "pos", "later").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    placed = written(placed.withColumn("label", F.coalesce("label", "doc")), "gram-labels")
    mixed = placed.groupBy("gram").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")
    )
    return written(placed.join(mixed.where("low <> high").select("gram", "size"), "gram"), "gram-rest")


def _with_pivots(rest: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b) of group members with PIVOTS of their group."""
    row = rest.drop("size")
    own = ("doc", "n", "pos", "later", "label")
    drawn = (
        F.min(F.struct(F.xxhash64(F.lit(turn * PIVOTS + k), F.col("doc")).alias("draw"), *own)) for k in range(PIVOTS)
    )
    pivots = rest.groupBy("gram").agg(F.array_distinct(F.array(*drawn)).alias("pivots"))
    one = pivots.select("gram", F.explode("pivots").alias("one")).select("gram", *(f"one.{c}" for c in own))
    pairs = _side(row, "a").join(_side(one, "b"), "gram").where((F.col("labela") != F.col("labelb")) & _possible(percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _all_pairs(rest: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of group members in different components that can link
    by their bitmaps. A group of more than PART members is dealt out in parts, each
    to be paired with all members. The rows are few for the work they make,
    so the number of partitions is given."""
    count = int(rest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.ceil(F.col("size") / PART).cast("int")
    rows = rest.withColumn("parts", parts).drop("size").join(facts.select("doc", "bits"), "doc")
    left = rows.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).drop("parts")
    right = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    may = (F.col("a") < F.col("b")) & (F.col("labela") != F.col("labelb")) & _possible(percent) & _by_bitmap(percent)
    left, right = (x.repartition(count, "gram", "part") for x in (_side(left, "a"), _side(right, "b")))
    return left.join(right, ["gram", "part"]).where(may).select("a", "b").distinct()


def _links(docs: DataFrame, order_, repeated_, ids: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The candidate pairs that link: overlaps per fragment, summed. The
    texts are not shuffled: a filter of the ids of the pairs' nodes picks
    them."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    wanted = shipped(docs.sparkSession, id_filter(ids.join(nodes, "doc", "left_semi").select("id"), "id"))
    segments = _once(
        _packed(
            docs.select("doc", "text", places("doc").alias("places")).mapInArrow(
                _segments(order_, wanted, repeated_, n), "doc bigint, again boolean, fragment int, grams array<bigint>"
            ),
            "segments",
        ),
        "doc", "fragment",
    )
    left = segments.withColumnsRenamed({"doc": "a", "grams": "ga"})
    right = segments.withColumnsRenamed({"doc": "b", "grams": "gb"})
    counted = (
        pairs.join(left, "a").join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("ga", "gb")).alias("common"))
        .groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    )
    return written(counted.where(_linked(F.col("common"), percent)).select("a", "b"), "links")


def _docs(documents: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    doc = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc")
    return documents.select(doc, F.col(text_col).alias("text"), *more)


def _classes(docs: DataFrame, n: int, percent: int, fragments: int) -> tuple[DataFrame, DataFrame]:
    """The documents' sets (doc, k1, k2, n), and the classes of equal sets
    that are not empty: k1, k2, head (smallest document), first (the class
    of the component with the smallest document: doc, k1, k2)."""
    spark = docs.sparkSession
    order = shipped(spark, Order.over(docs, n, fragments))
    sets = _packed(docs.select("doc", "text").mapInArrow(_keys(n), KEYS), "gram-sets")
    classes = written(
        sets.where("n > 0").groupBy("k1", "k2").agg(F.min("doc").alias("head"))
        .withColumn("node", F.col("k1").bitwiseXOR(F.col("head"))), "gram-classes",
    )

    # Leading n-grams of one document of each class, and of a few more that
    # the filter of ids lets pass.
    wanted = shipped(spark, id_filter(classes, "head"))
    repeated = shipped(spark, id_filter(sets.groupBy("doc").count().where("count > 1"), "doc"))
    leads = written(
        docs.select("doc", "text", places("doc").alias("places")).mapInArrow(
            _leads(order, wanted, repeated, n, percent), "doc bigint, id bigint, again boolean, n bigint, bits array<bigint>, lead array<bigint>"
        ),
        "gram-lead",
    )
    ids = leads.select("doc", "id")
    once = _once(leads, "doc")
    lead = once.select("doc", "n", F.posexplode("lead").alias("pos", "gram"))
    heads = lead.groupBy("gram").agg(F.min("doc").alias("head"), F.count("*").alias("members")).where("members > 1")
    from_here = F.count("*").over(Window.partitionBy("doc").orderBy(F.desc("pos")))
    groups = written(lead.join(heads, "gram").withColumn("later", from_here), "gram-groups")
    facts = written(_facts(once, groups), "gram-facts")

    # Every member against the smallest of its group.
    row = groups.select("gram", "doc", "n", "pos", "later", "head")
    member = _side(row.where("doc <> head").drop("head"), "b")
    head = _side(row.where("doc = head").drop("head"), "a")
    stars = member.join(head, "gram").where(_possible(percent)).select("a", "b").distinct()
    checked = written(_likely(stars, facts, percent), "gram-pairs")
    labels = components(_links(docs, order, repeated, ids, checked, n, percent))

    # Members of one group, but its head, that can link with each other and
    # are still in different components: first against pivots, then all of them.
    rest = _unlike(_matched(groups, facts, percent), labels)
    for turn in range(TURNS + 1):
        pairs = _with_pivots(rest, percent, turn) if turn < TURNS else _all_pairs(rest, facts, percent)
        pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        pairs = written(_likely(pairs, facts, percent), "gram-more")
        if pairs.isEmpty():
            continue
        labels = components(_links(docs, order, repeated, ids, pairs, n, percent), labels)
        if turn < TURNS:
            checked = checked.unionByName(pairs)
            rest = _unlike(rest, labels)

    # The label is the smallest node, which says nothing of the ids.
    placed = written(classes.join(labels, "node", "left").select("k1", "k2", "head", "label"), "gram-placed")
    linked = placed.where("label is not null")
    own = F.struct(F.col("head").alias("doc"), "k1", "k2")
    smallest = linked.groupBy("label").agg(F.min(own).alias("first"))
    alone = placed.where("label is null").select("k1", "k2", "head", own.alias("first"))
    return sets, alone.unionByName(linked.join(smallest, "label").select("k1", "k2", "head", "first"))


def ngram_join(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85,
    fragments: int = FRAGMENTS,
) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest document of an
    equal set) and component_id (smallest document reachable by links of
    Jaccard similarity >= percent / 100)."""
    sets, classes = _classes(_docs(documents, id_col, text_col), n, percent, fragments)
    return sets.join(classes, ["k1", "k2"], "left").select(
        _id(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        _id(F.coalesce("head", "doc")).alias("class_id"),
        _id(F.coalesce("first.doc", "doc")).alias("component_id"),
    )


def _id(doc: Column) -> Column:
    return F.when(doc != NO_ID, doc)


def one_of_each(documents: DataFrame, *, n: int = 4, percent: int = 85, fragments: int = FRAGMENTS) -> DataFrame:
    """``documents`` without near duplicates: of each component a row with
    its smallest id stays. Of rows with an empty set, one of each id stays,
    and all without an id."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    docs = _docs(documents, "doc_id", "text", F.struct(*rest).alias("row"))
    sets, classes = _classes(docs, n, percent, fragments)
    schema = T.StructType.fromDDL(KEYS)
    for field in docs.select("row", "text").schema:
        schema = schema.add(field)
    run = _keys(n, "row", "text")
    empty = sets.where((F.col("n") == 0) & (F.col("doc") != NO_ID)).select("doc", "k1", "k2").distinct()
    # Each component's row, and one of each id with an empty set.
    stays = classes.select("first.*").distinct().unionByName(empty)
    kept = docs.mapInArrow(run, schema).join(stays, ["doc", "k1", "k2"], "left_semi").dropDuplicates(["doc", "k1", "k2"])
    every = kept.unionByName(docs.where(F.col("doc") == NO_ID).mapInArrow(run, schema).where("n = 0"))
    return every.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns))
