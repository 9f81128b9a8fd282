"""Operators with exact results, against plain Python versions."""

from __future__ import annotations

import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantlens.llm import decontaminate, line_dedup, mixing, ngram_join, pii, quality_rules
from plantlens.llm import components as components_module
from plantlens.llm.components import components
from plantlens.llm.fm_index import FMIndex, suffix_array

WORDS = [f"w{i}" for i in range(60)]


def prose(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def copies():
    """Near copies in a few families, some of them large, and strangers."""
    draw = random.Random(7)
    docs = []
    for family in range(6):
        base = [f"{family}x{draw.randrange(400)}" for _ in range(120)]
        for _ in range(40 if family == 0 else 5):
            own = list(base)
            for _ in range(draw.randrange(5)):
                own[draw.randrange(len(own))] = draw.choice(WORDS)
            docs.append(" ".join(own))
    docs += [docs[3]] * 4 + [prose(draw, k) for k in (1, 2, 3, 4, 50, 200)] * 2
    draw.shuffle(docs)
    return list(enumerate(docs, 100))


# --- line dedup --------------------------------------------------------------------


def lines(draw: random.Random) -> list[tuple]:
    pool = [prose(draw, k) for k in range(1, 9)] + ["short", "  Padded line here \t", "padded LINE here", "ÀÉÎ ünïcödé x"]
    return [(i, "\n".join(draw.choice(pool) for _ in range(draw.randrange(8)))) for i in range(60)]


def test_line_dedup(documents):
    docs = lines(random.Random(1))
    got = {r[0]: tuple(r[1:]) for r in line_dedup.digest(documents(docs)).collect()}
    assert got == brute.line_dedup(docs)


def test_line_index_is_reversible(documents):
    docs = lines(random.Random(2))
    first, second = docs[:30], docs[30:]
    index = line_dedup.LineIndex.build(documents(first)).insert(documents(second))

    def state(index, rows):
        kept = index.apply(documents(rows)).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
        return {r[0]: tuple(r[1:]) for r in kept.collect()}

    assert state(index, docs) == brute.line_dedup(docs)
    gone = [d for d, _ in docs if d % 3 == 0]
    left = [(d, t) for d, t in docs if d % 3]
    index = index.delete(documents([(d, "") for d in gone]).select("doc_id"))
    assert state(index, left) == brute.line_dedup(left)
    index = index.insert(documents([(d, t) for d, t in docs if d % 3 == 0]))
    assert state(index, docs) == brute.line_dedup(docs)


def python_steps(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_lines_are_split_and_probed_by_one_worker(documents):
    """Python steps in a row keep a worker each in memory."""
    docs = documents(lines(random.Random(3)))
    assert python_steps(line_dedup.LineIndex.build(docs).drops(docs)) == 1


def test_cuckoo_filter_holds_and_forgets():
    draw = np.random.default_rng(0)
    k1, k2 = draw.integers(-(2**63), 2**63 - 1, (2, 5000))
    made = line_dedup.Cuckoo.of(k1, k2)

    def holds(keys1, keys2):
        row = type("Row", (), {"shard": 0, "buckets": made.buckets, "cells": made.table.tobytes()})
        return line_dedup.Filters(1, [row]).holds(keys1, keys2)

    assert holds(k1, k2).all()
    other = draw.integers(-(2**63), 2**63 - 1, (2, 20000))
    assert holds(*other).mean() < 0.01
    for place in zip(*made.places(k1[:2500], k2[:2500])):
        assert made.delete(*place)
    assert holds(k1[2500:], k2[2500:]).all()
    assert holds(k1[:2500], k2[:2500]).mean() < 0.01


# --- n-gram join ---------------------------------------------------------------------


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_ngram_join(documents, copies, n, percent):
    got = ngram_join.ngram_join(documents(copies), n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(copies, n, percent)


def test_groups_are_paired_in_turns_and_parts(documents, monkeypatch):
    """Near copies of which some link only through others, and one passage
    with differing ends."""
    for name, value in (("TURNS", 1), ("PIVOTS", 1), ("PART", 4)):
        monkeypatch.setattr(ngram_join, name, value)
    draw = random.Random(5)
    rows = []
    for i in range(36):
        words = [f"w{k}" for k in range(120)]
        for _ in range(draw.randrange(5)):
            words[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(i, passage + "".join(f" t{i}-{k}" for k in range(draw.randrange(1, 12)))) for i in range(36, 56)]
    want = brute.components(rows, 4, 85)
    assert 10 < len({c for _, c in want.values()}) < 50
    got = ngram_join.ngram_join(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_members_that_cannot_link_are_not_carried_through_the_turns(documents, monkeypatch):
    """Texts of common words, which share leading n-grams but link with
    nothing, and near copies of one of other lengths."""
    draw = random.Random(8)
    texts = [[f"w{k}" for k in draw.sample(range(600), 40)] for _ in range(60)]
    texts += [texts[0][k:] + [f"x{k}"] for k in (1, 2, 3, 4, 7)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    carried = []

    def written(df, label, write=ngram_join.written):
        out = write(df, label)
        carried.extend([r.doc for r in out.select("doc").distinct().collect()] if label == "gram-rest" else [])
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    got = ngram_join.ngram_join(documents(rows), n=1).collect()
    want = brute.components(rows, 1, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) in range(60, 62)
    assert len(set(carried)) <= 6


def test_tables_made_of_texts_are_written_in_few_files(documents, monkeypatch, copies):
    """One file, not one a task, for what is far smaller than a file."""
    files = {}

    def written(df, label, write=ngram_join.written):
        out = write(df, label)
        files.setdefault(label, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    got = ngram_join.ngram_join(documents(copies).repartition(9)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(copies, 4, 85)
    assert files["gram-sets"] == [1]
    assert set(files["segments"]) == {1}


def test_bitmaps_differ_in_no_more_cells_than_sets():
    draw = np.random.default_rng(3)
    for size in (0, 1, 40, 900):
        every = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        one, two = (every[draw.random(len(every)) < 0.8] for _ in range(2))
        cells = int(np.bitwise_count(ngram_join.bitmap(one) ^ ngram_join.bitmap(two)).sum())
        assert cells <= len(np.setxor1d(one, two))


def test_ngram_sets_of_odd_texts(monkeypatch):
    """Sets by hash have the sizes and overlaps of sets of word tuples, over
    pieces of any size, of texts one by one and together."""
    draw = random.Random(3)
    odd = ["", " \t\n", "a", "A", "a b", "b a", "aa a", "a aa", "x" * 70_000 + " y z w v", " \x0bÀé\x0c É\r\x00 \u2003b\u2003 q"]
    texts = odd + [prose(draw, k).replace(" w1", "\tW1") for k in (2, 3, 4, 5, 40, 900)] * 2

    def brute_set(text):
        words = [w for w in text.encode().lower().split()]
        return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()

    raw, want = [t.encode() for t in texts], [brute_set(t) for t in texts]
    for piece in (1 << 16, 50, 1):
        monkeypatch.setattr(ngram_join, "PIECE", piece)
        grams = ngram_join.Grams(4)
        got = grams.sets(raw)
        assert all((a == b).all() for t, a in zip(raw, got) for b in grams.sets([t]))
        assert grams.sets([]) == []
        for i, a in enumerate(got):
            assert (np.diff(a.astype(object)) > 0).all()
            assert [len(np.intersect1d(a, b)) for b in got] == [len(want[i] & w) for w in want]


def test_ngram_sets_take_the_same_memory_for_any_vocabulary():
    """What a task holds does not grow with the distinct words it has met."""
    texts = [" ".join(f"{k}w{i}" for i in range(4000)) for k in range(60)]

    def batches():
        for k, text in enumerate(texts):
            yield pa.RecordBatch.from_pydict({"doc": pa.array([k], pa.int64()), "text": [text]})

    tracemalloc.start()
    sizes = [n for batch in ngram_join._keys(4)(batches()) for n in batch.column("n").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [3997] * 60
    assert peak < 12e6


def test_chains_and_rings_are_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100), (7, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys([*range(61), 200], 0), **dict.fromkeys((100, 101, 102), 100)}


def test_links_of_many_nodes_with_the_same_heads_are_thinned_out(spark, monkeypatch):
    """Components, at once and in two parts, and how many links are spread:
    fewer than twice the nodes."""
    draw = random.Random(4)
    links = [(head, i) for i in range(100, 400) for head in draw.sample(range(i % 2, 40, 2), 10)]
    more = [(100, 102), (398, 500), (500, 501), (600, 601), (601, 601), (700, 700)]
    spread = []

    def written(df, label, write=components_module.written):
        out = write(df, label)
        spread.append(out.count() if label == "links" else 0)
        return out

    monkeypatch.setattr(components_module, "written", written)

    def labels(*parts):
        known = None
        for part in parts:
            known = components(spark.createDataFrame(part, "a bigint, b bigint"), known)
        found = [(r.node, r.label) for r in known.collect()]
        assert len(found) == len(dict(found))
        return dict(found)

    ids = {i for link in links for i in link}
    assert labels(links) == {i: i % 2 for i in ids}
    assert len(links) == 3000 and 0 < max(spread) < 2 * len(ids)
    want = {i: i % 2 for i in ids} | {500: 0, 501: 0, 600: 600, 601: 600, 700: 700}
    assert labels(links + more) == want
    spread.clear()
    assert labels(links, more, [(0, 1)]) == {i: c if c >= 600 else 0 for i, c in want.items()}
    assert spread[0] > 300 and max(spread[1:]) <= len(more)
    assert labels(links, [(0, 2)]) == {i: i % 2 for i in ids}


def test_one_of_each(documents, copies):
    kept = {r.doc_id for r in ngram_join.one_of_each(documents(copies), n=5, percent=80).collect()}
    assert kept == {c for _, c in brute.components(copies, 5, 80).values()}


@pytest.fixture(scope="module")
def unnumbered():
    """Rows without an id and with repeated ids, by name: (id, text)."""
    draw = random.Random(12)
    texts = {k: prose(draw, 60) for k in ("five", "nine", "clean", "other", "first", "second")}
    near = {k: texts[k] + " end" for k in ("five", "nine")}
    rows = [
        (5, texts["five"]), (9, texts["nine"]), (None, near["five"]), (None, near["nine"]),
        (None, texts["clean"]), (None, texts["clean"]), (None, texts["other"]),
        (20, texts["first"]), (20, texts["second"]), (20, texts["first"]), (30, ""), (30, ""), (None, ""), (None, None),
    ]
    return texts, near, rows


def test_rows_without_own_ids_link_by_their_texts(documents, unnumbered):
    texts, near, rows = unnumbered
    got = ngram_join.ngram_join(documents(rows)).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)
    ids = {near["five"]: 5, near["nine"]: 9}
    want = [(i, len(brute.shingles(t, 4)), i if i is not None else ids.get(t)) for i, t in rows]
    assert found == sorted(want, key=str)


def test_one_of_each_keeps_different_texts_without_own_ids(documents, unnumbered):
    texts, _, rows = unnumbered
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(documents(rows)).collect()]
    want = [
        (5, texts["five"]), (9, texts["nine"]), (None, texts["clean"]), (None, texts["other"]),
        (20, texts["first"]), (20, texts["second"]), (30, ""), (None, ""), (None, None),
    ]
    assert sorted(kept, key=str) == sorted(want, key=str)


# --- decontamination -------------------------------------------------------------------


def test_all_blocks_are_scanned_and_cut_by_one_worker(documents, benchmark):
    docs = documents([(1, "a b c d"), (2, "x y z")])
    items = benchmark([(k, f"{w} {w}") for k, w in enumerate("abc")])
    assert python_steps(decontaminate.contamination(docs, items, block_words=2)) == 1
    assert python_steps(decontaminate.decontaminate(docs, items, block_words=2)) == 1


def test_suffix_array_and_search():
    draw = np.random.default_rng(3)
    symbols = draw.integers(0, 4, 3000)
    symbols[-1] = 0
    order = suffix_array(symbols)
    ends = np.flatnonzero(symbols == 0)
    ranks = symbols + len(ends)
    ranks[ends] = np.arange(len(ends))
    keys = [tuple(ranks[i : i + 200]) for i in order]
    assert sorted(order) == list(range(len(symbols))) and keys == sorted(keys)
    index = FMIndex(symbols)
    patterns = draw.integers(1, 4, (50, 5))
    lengths = draw.integers(1, 6, 50)
    low, high = index.search(patterns, lengths)
    for row, size, a, b in zip(patterns, lengths, low, high):
        own = row[5 - size :]
        want = [i for i in range(len(symbols) - size + 1) if (symbols[i : i + size] == own).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


@pytest.fixture(scope="module")
def leaks():
    draw = random.Random(11)
    items = [(i, prose(draw, k)) for i, k in enumerate((0, 1, 4, 10, 11, 30, 30, 60))] + [(50, None)]
    docs = []
    for i in range(40):
        item = draw.choice(items)[1] or ""
        parts = [prose(draw, draw.randrange(40)), item.title().replace(" ", ", "), prose(draw, draw.randrange(300))]
        docs.append((i, "\n".join(parts[: draw.randrange(1, 4)])))
    return docs, items


@pytest.mark.parametrize("options", [{}, {"shard_words": 64}, {"block_words": 20}, {"shard_words": 25, "block_words": 70}])
def test_contamination(documents, benchmark, leaks, options):
    docs, items = leaks
    want = brute.contamination(docs, items)
    found = decontaminate.contamination(documents(docs), benchmark(items), **options)
    for r in found.collect():
        hit = {k for s in r.spans for k in range(s.start, s.end)}
        assert (r.n_words, hit, set(r["items"])) == want[r.doc_id]
    for r in decontaminate.digest(found).collect():
        n, hit, names = want[r.doc_id]
        assert tuple(r)[1:] == (n, len(hit), len(names), brute.sha(",".join(sorted(names))), bool(hit))


@pytest.mark.parametrize("options", [{}, {"shard_words": 64, "block_words": 20}])
def test_cut_texts_hold_what_is_left(documents, benchmark, leaks, options):
    docs, items = leaks
    want = brute.contamination(docs, items)
    for r in decontaminate.decontaminate(documents(docs), benchmark(items), **options).collect():
        text = dict(docs)[r.doc_id]
        left = [w for k, w in enumerate(brute.item_words(text)) if k not in want[r.doc_id][1]]
        if not options:
            assert brute.item_words(r.text) == left
        assert r.n_chars == len(r.text) and (want[r.doc_id][1] or r.text == text)


@pytest.mark.parametrize("options", [{}, {"block_words": 10}, {"block_words": 20}])
def test_overlapping_items_of_two_blocks_are_cut_whole(documents, benchmark, options):
    words = [f"w{k}" for k in range(1, 16)]
    items = [(1, " ".join(words[:10])), (2, " ".join(words[5:])), (3, "left " * 5 + "right " * 5)]
    docs = [
        (1, " ".join(["before", *words, "after"])),
        # What stands on both sides of a cut is no occurrence of item 3.
        (2, "left " * 5 + " ".join(words[:10]) + " right" * 5),
    ]
    got = {r.doc_id: r.text.split() for r in decontaminate.decontaminate(documents(docs), benchmark(items), **options).collect()}
    assert got == {1: ["before", "after"], 2: ["left"] * 5 + ["right"] * 5}


@pytest.mark.parametrize("options", [{"block_words": 20}, {"shard_words": 25, "block_words": 70}])
def test_cut_texts_do_not_depend_on_the_blocks(documents, benchmark, leaks, options):
    docs, items = leaks
    want = brute.contamination(docs, items)
    for r in decontaminate.decontaminate(documents(docs), benchmark(items), **options).collect():
        every = enumerate(brute.item_words(dict(docs)[r.doc_id]))
        assert brute.item_words(r.text) == [w for k, w in every if k not in want[r.doc_id][1]]


# --- personal data ----------------------------------------------------------------------


def test_personal_data(documents):
    texts = [
        "a@b.c_d@e.fg h..i@j.k l@m n@o.p.q r@-s.t", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 9999999999999999999999.1.1.1",
        "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 4 1 1 1", "+49 (30) 901-820 +1 +1 2 +123456789012345678",
        "é🙂 x@y.zz 🙂 +1 (222) 333-4444 é 10.0.0.1", "", "@ . + -", "name(at)host(dot)org", "call (222) 333-4444 now",
        "mail a@b.cc\nb@c.dd\n\n4111111111111111\n", "12345678901234567890123 " * 40, "a" * 30_000 + "@b.cc " + "1 " * 30_000,
    ]
    docs = list(enumerate(texts))
    for r in pii.digest(pii.personal_data(documents(docs))).collect():
        want = brute.personal(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(want)), (texts[r.doc_id][:80], want, r.spans)
        spans = [s for s in r.spans.split(",") if s]
        assert set(want) <= set(spans) and len(set(spans)) == len(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in brute.PERSONAL]


def test_boosted_trees_add_what_looks_alike(documents):
    """Numbers in the place and form of confirmed phones, where nearly all
    such numbers are confirmed, are redacted too."""
    rows = [(i, f"call +1 (222) 333-44{i % 100:02d} now") for i in range(200)]
    rows += [(i, f"sum {i}00 of 12-{i % 10}") for i in range(200, 300)]
    odd = "call +1 (222) 333-4444 555-6666 77 now"  # too many digits for the check
    found = {r.doc_id: r for r in pii.digest(pii.personal_data(documents([*rows, (999, odd)]))).collect()}
    assert found[0].spans.startswith("phone:5:")
    assert found[250].spans == ""
    text = {r.doc_id: r.text for r in pii.redact(documents(rows[:3] + [(500, None)])).collect()}
    assert text == {**{i: "call [phone] now" for i in range(3)}, 500: None}


def test_trees_find_what_is_written_otherwise(documents):
    """Spelled-out addresses, phones without a country and cards with other
    marks, among numbers and words in other places."""
    def card(i):
        digits = f"4000{i:011d}"
        total = sum(d if k % 2 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, digits)))
        return digits + str(-total % 10)

    def fours(number, mark):
        return mark.join(number[k:k + 4] for k in range(0, 16, 4))

    base, wide, other = [], [], []
    for i in range(60):
        base += [f"write to ann{i}@mail{i % 7}.com today", f"phone +1 555-123-{1000 + i} please",
                 f"visa {fours(card(i), ' ')} ok", f"server 10.0.0.{i} is up"]
    for i in range(20):
        wide += [(f"write to ", f"bob{i} (at) mail{i % 7} (dot) com", " today", "email"),
                 (f"write to ", f"eve{i} at mail dot com", " today", "email"),
                 (f"phone ", f"555-123-{2000 + i}", " please", "phone"),
                 (f"visa ", fours(card(500 + i), "  "), " ok", "card"),
                 (f"visa ", fours(card(700 + i), "/"), " ok", "card"),
                 (f"server ", f"10[.]0[.]0[.]{i}", " is up", "ip")]
        other += [f"on 2024-01-{10 + i} we met", f"sums of 1{i:02d},2,3,4 each", f"part 90{i:02d}817263 sold",
                  f"see you at noon dot matrix{i}", f"file {card(i)[:-1]}{(int(card(i)[-1]) + 1) % 10} lost"]
    texts = base + [before + span + after for before, span, after, _ in wide] + other
    got = pii.digest(pii.personal_data(documents(list(enumerate(texts))))).collect()
    added = {(r.doc_id, s) for r in got for s in r.spans.split(",") if s and s not in brute.personal(texts[r.doc_id])}
    planted = {(len(base) + i, f"{kind}:{len(before)}:{len(before) + len(span)}")
               for i, (before, span, _, kind) in enumerate(wide)}
    assert len(added & planted) >= 0.9 * len(planted), sorted(planted - added)[:20]
    assert len(added & planted) >= 0.9 * len(added), sorted(added - planted)[:20]
    for r in got:
        assert r.base_sha256 == brute.sha(",".join(brute.personal(texts[r.doc_id])))


# --- rules and mixing --------------------------------------------------------------------


def test_quality_counts(documents):
    draw = random.Random(5)
    texts = [prose(draw, k) + "\n\n \n" + "|# $\nsame line\nsame line\n" * (k % 3) for k in range(0, 120, 7)]
    texts += ["a b c a b c a", "a a a a", "", "é é é é\x0bü", "x\r\nx\r\n"]
    docs = [(i, t, "en", "s") for i, t in enumerate(texts)]
    for r in quality_rules.quality_rules(documents(docs)).collect():
        want = brute.quality_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_fences_follow_their_group(documents):
    """The same text passes among its like and fails among others."""
    draw = random.Random(6)
    plain = [(i, prose(draw, 80), "en", "a") for i in range(60)]
    table = " | ".join(WORDS)
    rows = plain + [(100, table, "en", "a")] + [(200 + i, table + f" x{i}", "en", "b") for i in range(30)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(documents(rows)).collect()}
    assert all(kept[i] for i in range(60)) and not kept[100] and all(kept[200 + i] for i in range(30))


def test_sketches_merge(documents):
    draw = random.Random(8)
    rows = [(i, prose(draw, draw.randrange(1, 90)), draw.choice(["en", None]), draw.choice("ab")) for i in range(120)]
    whole = quality_rules.sketches(quality_rules.measured(documents(rows)))
    parts = [quality_rules.sketches(quality_rules.measured(documents(rows[k::3]))) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(str, quality_rules.fences(whole).collect())) == sorted(map(str, quality_rules.fences(merged).collect()))


def test_mixing(documents):
    draw = random.Random(9)
    sources = ["a", "b", "B", "é", "z", None]
    rows = [(i, prose(draw, draw.randrange(60)), "en", draw.choice(sources[: 3 + 3 * (i % 7 == 0)])) for i in range(500)]
    sizes = dict.fromkeys(sorted({r[3] for r in rows} - {None}) + [None], 0)
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    want = brute.mix_targets(sizes)
    source = {r[0]: r[3] for r in rows}
    got = mixing.mix(documents(rows)).collect()
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.size == len(brute.words(rows[r.doc_id][1])) and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]]) and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(documents(rows)).collect()))


def test_mixing_follows_document_weights(documents):
    rows = [(i, "w " * 20, "en", "a" if i % 2 else "b") for i in range(400)]
    docs = documents(rows).withColumn("w", F.when(F.col("doc_id") % 4 < 2, 0.2).otherwise(1.0))
    got = mixing.mix(docs, weight_col="w").collect()
    rate = {(r.doc_id % 4): r.rate for r in got}
    taken = [sum(r.taken for r in got if r.doc_id % 2 == k) for k in (0, 1)]
    targets = {r.doc_id % 2: r.target for r in got}
    assert all(abs(taken[k] - targets[k]) <= 0.5 for k in (0, 1))
    assert rate[2] / rate[0] == pytest.approx(5) or rate[2] == 2
    assert max(r.taken / r.size for r in got) <= 2
