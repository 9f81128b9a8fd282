"""Learned operators: held-out accuracy, and exact parts."""

from __future__ import annotations

import math
import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from plantlens.llm import lm_score, quality_classifier, toxicity
from plantlens.llm.boosting import Boosted, Cell
from plantlens.llm.common import table

SF = "/root/testdata/sf0.01"
INSULTS = ("idiot", "stupid", "moron", "trash")


def held_out(scored, labels, label):
    found = scored.join(labels.select("doc_id", label), "doc_id").where(f"held_out and {label} is not null").collect()
    return np.array([r.score for r in found]), np.array([r[label] for r in found])


def auc(scores, truth):
    good, bad = scores[truth == 1], scores[truth == 0]
    return np.mean((good[:, None] > bad[None]) + 0.5 * (good[:, None] == bad[None]))


# --- toxicity ------------------------------------------------------------------------


def kernel_brute(a: str, b: str) -> float:
    """Sum over pairs of equal subsequences of DECAY to the spans."""
    from itertools import combinations

    def spans(s):
        out = Counter()
        for at in combinations(range(len(s)), toxicity.ORDER):
            out["".join(s[i] for i in at), at[-1] - at[0] + 1] += 1
        return out

    x, y = spans(a), spans(b)
    return sum(
        n * m * toxicity.DECAY ** (i + j) for (u, i), n in x.items() for (v, j), m in y.items() if u == v
    )


@pytest.mark.parametrize(("a", "b"), [("idiot", "idiot"), ("idxiiot", "idiot"), ("stupid", "upstudip"), ("moron", "xyz")])
def test_kernel(a, b):
    rows = toxicity.matrix([a.encode()])[:, : len(a)].T
    got = toxicity.kernel([(rows == c).astype(float) for c in b.encode()])
    assert got[0] == pytest.approx(kernel_brute(a, b))


def test_masked_letters_and_other_scripts_are_compared():
    """The kernel decides for every unit that has a subsequence of a
    landmark, whatever letters are missing and in every script."""
    words = [b"idiot", b"stupid", "\u0434\u0443\u0440\u0430\u043a".encode(), "\u50bb\u74dc".encode(), b"aaaa"]
    marks = toxicity.Landmarks(words)
    assert np.diag(marks.closeness(words)) == pytest.approx(np.ones(len(words)))
    masked = [toxicity.units(t)[0] for t in (b"id*ot", b"id1ot", b"st*pid")]
    near = marks.closeness(masked)
    assert near[0, 0] > 0 and near[1, 0] > 0 and near[2, 1] > 0 and not near[:, 2:].any()

    draw = random.Random(14)
    strings = ["".join(draw.choice("aidostupx") for _ in range(draw.randrange(1, 12))).encode() for _ in range(300)]
    near = marks.closeness(strings)
    for k, mark in enumerate(words[:2]):
        alone = kernel_brute(mark.decode(), mark.decode())
        for row, unit in zip(near, strings):
            value = kernel_brute("".join(c if c.encode() in mark else " " for c in unit.decode()), mark.decode())
            assert (row[k] > 0) == (value >= toxicity.LEAST * alone)


def test_single_precision_rules_out_what_is_far_below_least(monkeypatch):
    """It errs by less than ROUNDING, also in the longest strings; only what
    it lets pass is computed in double precision, with the same results."""
    draw = random.Random(5)
    strings = ["".join(draw.choice("abcd") for _ in range(toxicity.WIDTH)).encode() for _ in range(200)]
    rows = toxicity.matrix(strings).T
    match = rows[:, :100] == rows[:, None, 100:]
    exact = toxicity.kernel(match)
    assert np.abs(toxicity.kernel(match, np.float32) / exact - 1).max() < toxicity.ROUNDING / 10

    mark = b"worthless"
    units = [b"worthless", b"worxthless", b"wxoxrxtx", b"other", b"wortbcdefg", b"wrhesoxt"]
    landmarks = np.repeat(toxicity.matrix([mark]).T[: len(mark)], len(units), axis=1)
    alone = np.full(len(units), kernel_brute(mark.decode(), mark.decode()))
    plain, pairs = toxicity.kernel, []

    def counted(match, kind=np.float64):
        pairs.append((kind, np.asarray(match).shape[2]))
        return plain(match, kind)

    monkeypatch.setattr(toxicity, "kernel", counted)
    found = toxicity.closeness(toxicity.matrix(units).T, landmarks, alone)
    both = [kernel_brute("".join(c if c.encode() in mark else " " for c in u.decode()), mark.decode()) for u in units]
    want = np.array(both) >= toxicity.LEAST * alone
    assert (found > 0).tolist() == want.tolist() and 0 < want.sum() < len(units)
    assert pairs[0] == (np.float32, len(units)) and {n for kind, n in pairs[1:] if kind is np.float64} == {want.sum()}


def test_spelled_runs_are_looked_for_only_where_they_can_be(monkeypatch):
    """The pattern is not run over texts without one; the units stay."""
    texts = [b"a b c", b"x a\tb c", b"a b", b" a b c\n", b"aa b c d", b"a\nb c d", b"a b\nc", b"1 - 2", b"\xc3 b c d e", b"plain words of a text"]

    def every(text):
        text = text.lower()
        runs = [b"".join(r.split()).translate(None, toxicity.INSERTED) for r in toxicity.SPELLED.findall(text)]
        return text.translate(None, toxicity.INSERTED).split() + runs

    assert [toxicity.units(t) for t in texts] == [every(t) for t in texts]
    monkeypatch.setattr(toxicity, "SPELLED", None)
    assert toxicity.units(b"Plain words of a text I.D!iot") == [b"plain", b"words", b"of", b"a", b"text", b"idiot"]


def test_units_spell_and_clean():
    assert toxicity.units(b"You I.D!iot9 i d i o t") == [b"you", b"idiot", b"i", b"d", b"i", b"o", b"t", b"idiot"]
    assert b"".join(toxicity.units(b"x" * 100)[::2])[:96] == b"x" * 96


@pytest.fixture(scope="module")
def insulted(documents, labels):
    draw = random.Random(4)
    rows, marks = [], []
    for i in range(600):
        text = " ".join("".join(draw.choice("aehinorst") for _ in range(draw.randrange(2, 9))) for _ in range(40))
        toxic = i % 5 == 0
        if toxic:
            text = text.replace(" ", f" {draw.choice(INSULTS)} ", 1) + f".\nA {draw.choice(INSULTS)}!"
        rows.append((i, text))
        marks.append((i, 1, int(toxic)))
    more = [
        (1000, "one two id.io-t three"), (1001, "you s t u p i d person"), (1002, "what a MORXON that is"),
        (1003, "plain words of no offence at all"), (1004, None), (1005, ""),
    ]
    got = toxicity.toxicity(documents(rows + more), labels(marks)).collect()
    return {r.doc_id: r for r in got}, dict((m[0], m[2]) for m in marks)


def test_toxicity_held_out(insulted):
    found, truth = insulted
    held = [i for i in truth if brute.fold(i, 4) == 2]
    assert all(found[i].held_out == (brute.fold(i, 4) == 2) for i in found)
    right = [found[i].predicted == truth[i] for i in held]
    assert len(held) > 100 and np.mean(right) > 0.98


def test_toxicity_sees_through_gaps(insulted):
    found, _ = insulted
    assert [found[i].predicted for i in range(1000, 1006)] == [1, 1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_toxicity_on_the_given_tables(spark):
    labels = table(spark, SF, "labels")
    scores, truth = held_out(toxicity.toxicity(table(spark, SF, "documents"), labels), labels, "toxic")
    assert ((scores >= 0.3) <= (truth == 1)).mean() > 0.97  # few of the others are called toxic
    assert auc(scores, truth) > 0.7


# --- quality -------------------------------------------------------------------------------


def test_quality_on_the_given_tables(spark):
    labels = table(spark, SF, "labels")
    scored = quality_classifier.quality(table(spark, SF, "documents"), labels)
    scores, truth = held_out(scored, labels, "quality")
    assert auc(scores, truth) > 0.97 and ((scores >= 0.3) == truth).mean() > 0.95
    rows = scored.collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 0) for r in rows)


def test_keep_good_agrees_with_the_scores(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r.doc_id for r in quality_classifier.quality(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in quality_classifier.keep_good(docs, labels).collect()} == good


# --- language model ---------------------------------------------------------------------------


@pytest.mark.parametrize("heavy", [lm_score.HEAVY, 50])
def test_base_score(documents, heavy):
    draw = random.Random(3)
    docs = [(i, " ".join(f"W{int(draw.paretovariate(0.8)) % 500}" for _ in range(draw.randrange(80)))) for i in range(300)]
    docs += [(900, None), (901, ""), (902, "never seen")]
    own = {i: [w.lower() for w in brute.words(t)] + [b"\n"] for i, t in docs}
    count = Counter(w for i, ws in own.items() if brute.fold(i, 5) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    got = lm_score.lm_scores(documents(docs), heavy=heavy).collect()
    assert len(got) == len(docs)
    for r in got:
        ws = own[r.doc_id]
        want = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (brute.fold(r.doc_id, 5) == 1, len(ws), n)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(want, abs=1e-9)
        assert r.score <= 1e-9


def test_pairs_help(documents):
    """Texts that follow the training texts' order score better than the
    same words shuffled."""
    draw = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(base[k : k + 30])) for i in range(300) for k in [draw.randrange(170)]]
    loose = " ".join(draw.sample(base[20:60], 30))
    tight = " ".join(base[20:50])
    new = [i for i in range(2000, 2100) if brute.fold(i, 5) == 1][:2]
    got = {r.doc_id: r.score for r in lm_score.lm_scores(documents([*docs, (new[0], tight), (new[1], loose)])).collect()}
    assert got[new[0]] > got[new[1]] + 10


def test_filter_never_underestimates():
    import pandas as pd

    draw = np.random.default_rng(1)
    grams = draw.integers(0, 2**64, 4000, np.uint64)
    counts = draw.geometric(0.2, 4000).astype(np.uint32)
    part = pd.DataFrame(
        {"block": [0], "grams": [grams.tobytes()], "counts": [counts.tobytes()], "classes": [bytes(4000)]}
    )
    row = lm_score._build(1 << 30)(part).iloc[0]
    level = np.frexp(counts.astype(float))[1]
    # Two block numbers that share the one block's bits.
    blocks = lm_score.Filter(
        1, np.frombuffer(row.bits, np.uint8), np.zeros(2, np.int64), np.full(2, row["size"]), np.full(2, row.probes)
    )
    estimate = blocks.counts(grams)
    middle = (2.0 ** (level - 1) + 2.0**level - 1) / 2
    assert (estimate >= middle).all() and np.mean(estimate == middle) > 0.9
    assert np.mean(blocks.counts(draw.integers(0, 2**64, 20_000, np.uint64)) > 0) < 0.05


def test_ngrams_are_shuffled_in_few_bytes():
    """A slice's n-grams, counts and classes, as the shuffle compresses
    them, and back."""
    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 50_000, 500)) for _ in range(400)]
    rows = pa.table({"slice": pa.array([1] * 400, pa.int64()), "held": [False] * 400, "text": texts})
    heavy = lm_score.Heavy(np.empty(0, np.uint64), np.empty(0, np.int64), 0, 0)
    parts = lm_score._count_grams(lambda: heavy, 6)(rows).to_pandas()
    own = lm_score.Slice([t.encode() for t in texts])
    sent = sum(len(pa.compress(bytes(x), codec="lz4_raw")) for name in ("grams", "counts", "classes") for x in parts[name])
    assert sent < 8 * len(own.grams)  # 13 bytes each before they are compressed
    grams = np.concatenate([np.cumsum(lm_score.unpacked(g, np.uint64), dtype=np.uint64) for g in parts.grams])
    counts = np.concatenate([lm_score.unpacked(c, np.uint32) for c in parts.counts])
    assert (grams == own.grams).all() and counts.sum() == len(own.tokens) * 2


def test_bits_for_an_entry_do_not_depend_on_the_size(documents, monkeypatch):
    """Scores with many small slices and blocks, and with few: no fixed
    number of bits is shared by all entries."""
    draw = random.Random(13)
    docs = [(i, " ".join(f"w{draw.randrange(400)}" for _ in range(60))) for i in range(200)] + [(None, "w1 w2"), (901, "")]

    def scores(**options):
        return sorted((str(r.doc_id), r.n_known, r.score) for r in lm_score.lm_scores(documents(docs), **options).collect())

    few = scores()
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 64)
    many = scores(slice_tokens=500)
    assert [x[:2] for x in few] == [x[:2] for x in many]
    # Other blocks have other chance hits, in a few of a hundred probes.
    assert np.mean([abs(x[2] - y[2]) / max(1, abs(x[2])) for x, y in zip(few, many)]) < 0.03


def test_boosting_learns_an_interaction():
    cells = [Cell((a, b), 100, 95 if a == 0 and b != 1 else 5) for a in range(3) for b in range(3)]
    model = Boosted.fit(cells)
    assert all(abs(model.probability(c.values) - c.positive / 100) < 0.05 for c in cells)


def test_boosted_expression_equals_the_model(spark):
    from pyspark.sql import functions as F

    cells = [Cell((a, b), 50, (7 * a + 11 * b) % 50) for a in range(4) for b in range(4)]
    model = Boosted.fit(cells)
    rows = spark.createDataFrame([c.values for c in cells], "a int, b int")
    for r in rows.select("a", "b", model.column([F.col("a"), F.col("b")]).alias("p")).collect():
        assert r.p == pytest.approx(model.probability((r.a, r.b)))


def test_good_documents_are_kept_slice_by_slice(documents, labels, monkeypatch):
    """A batch is scored in slices of bounded size, with the same result."""
    draw = random.Random(8)
    rows = [(k, " ".join(draw.choice("abcdefgh") * (1 + k % 2) for _ in range(40 + k % 7))) for k in range(60)]
    rows.append((60, None))
    docs, marks = documents(rows), labels([(k, k % 2, k % 2) for k in range(60)])
    want = {r.doc_id for r in quality_classifier.quality(docs, marks).where("predicted = 1").collect()}
    taken = []

    class Whole:
        """A model that notes how many texts it is given at once."""

        def score(self, x):
            taken.append(len(x))
            return np.ones(len(x))

    kept = quality_classifier.keep_good(docs, marks)
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) < len(rows)
    assert kept.schema == docs.schema

    run = {}
    monkeypatch.setattr(quality_classifier, "fit", lambda *a, **k: None)
    monkeypatch.setattr(quality_classifier, "shipped", lambda spark, value: Whole)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, function, schema: run.setdefault("f", function) and self)
    quality_classifier.keep_good(docs, marks)
    text = pa.array(["x" * 1000] * 5000)
    batch = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([text], ["text"])], ["row"])
    assert sum(b.num_rows for b in run["f"](iter([batch]))) == 5000
    assert len(taken) > 1 and max(taken) <= 2200
