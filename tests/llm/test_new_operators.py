"""Language identification, fill-in-the-middle and collocations against
plain Python versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import brute
import pytest
from pyspark.sql import functions as F

from plantlens.llm import collocations, fill_middle, language_id
from plantlens.llm.common import table

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
CLASHING = ("lang_pred", "gram", "n", "chunk", "phrase", "words", "a", "bucket", "rank", "output", "form", "h1", "body")


# --- language identification ------------------------------------------------------


def grams(text):
    """Counts of a text's n-grams."""
    own = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    count = Counter()
    for word in own:
        count.update(word)
    line = f" {' '.join(own)} " if own else ""
    count.update(line[i : i + 2] for i in range(len(line) - 1))
    count.update(g for i in range(len(line) - 2) if (g := line[i : i + 3])[1] != " ")
    return count


def first(count, places):
    def order(gram):
        return [ord(c) if c != " " else 0 for c in gram] + [-1] * (3 - len(gram))

    return sorted(count, key=lambda g: (-count[g], order(g)))[:places]


def plain_languages(rows, places):
    by_lang: dict[str, Counter] = {}
    for doc, text, lang in rows:
        if lang is not None and text is not None and brute.fold("" if doc is None else doc, 5) != 0:
            by_lang.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: {g: k for k, g in enumerate(first(c, places))} for lang, c in by_lang.items() if c}
    out = []
    for doc, text, _ in rows:
        own = first(grams(text), places)
        far = {
            lang: sum(abs(p[g] - k) if g in p else places for k, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(sorted(far), key=far.get) if own and far else "und"
        score = 1 - far[best] / (places * len(own)) if own and far else 0.0
        out.append((str(doc), brute.fold("" if doc is None else doc, 5) == 0, best, round(score, 9)))
    return sorted(out)


def answered(df):
    return sorted((str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("places", [7, 400])
def test_languages_equal_brute_force(documents, edge_rows, spark, places):
    more = [(r.doc_id, r.text, r.lang, None) for r in table(spark, SF, "documents").limit(60).collect()]
    greek = [(50 + i, f"αυτό είναι ένα κείμενο {i} 中文字符", "el", None) for i in range(5)]
    rows = edge_rows + more + greek + [(70, "123 ... 4", "en", None), (71, "abc", "empty", None), (72, "", "none", None)]
    got = answered(language_id.languages(documents(rows), places))
    assert got == plain_languages([r[:3] for r in rows], places)


def test_windows_of_a_long_text_count_each_ngram_once(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "bcd", "xyzzy", "é"]) for _ in range(500))
    whole = language_id.counted([(3, language_id.codes(text))])
    monkeypatch.setattr(language_id, "WINDOW", 7)
    for a, b in zip(whole, language_id.counted([(3, language_id.codes(text))])):
        assert a.tolist() == b.tolist()


def test_blocks_of_languages_change_nothing(documents, spark):
    rows = [(r.doc_id, r.text, r.lang, None) for r in table(spark, SF, "documents").limit(80).collect()]
    docs = documents(rows)
    learned = language_id.profiles(docs)
    want = language_id.identify(docs, learned).collect()
    for block in (1, 3):
        assert sorted(language_id.identify(docs, learned, block=block).collect()) == sorted(want)


def test_held_out_languages_are_found(spark):
    docs = table(spark, SF01, "documents")
    said = language_id.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r.lang == r.lang_pred for r in said)
    assert len(said) > 150 and right >= 0.97 * len(said)
    for lang in {r.lang for r in said}:
        own = [r for r in said if r.lang == lang]
        assert sum(r.lang_pred == lang for r in own) >= 0.9 * len(own)


# --- fill in the middle -----------------------------------------------------------


def plain_fill(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    name = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(name[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", text
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_outputs_equal_brute_force_and_can_be_undone(documents, edge_rows):
    rng = random.Random(5)
    odd = ["<P>", "<", "P>", "<S", "$1", "\\", "\\$2", "é", "😀", "\n", "\r\n", " ", "ab", "Z", " ", "\x00", "{2}"]
    rows = edge_rows + [(100 + i, "".join(rng.choices(odd, k=rng.randrange(12))), "en", "a") for i in range(300)]
    moved = fill_middle.fill_middle(documents(rows))
    got = sorted((str(r.doc_id), r.n, r.form, r.output) for r in moved.collect())
    assert got == sorted((str(r[0]), *plain_fill(r[0], r[1])) for r in rows)
    assert {form for _, _, form, _ in got} == {"plain", "psm", "spm"}
    back = sorted((str(r.doc_id), r.restored) for r in fill_middle.restored(moved).collect())
    assert back == sorted((str(r[0]), r[1] or "") for r in rows)


def test_a_million_units_do_not_end_the_stack(documents):
    text = "ab, é\n" * 200_000
    (row,) = fill_middle.fill_middle(documents([(2, text)])).collect()
    assert (row.n, row.form, row.output) == plain_fill(2, text) and row.n == 1_000_000 and row.form != "plain"


def test_fill_middle_is_one_stage(documents):
    plan = fill_middle.fill_middle(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- collocations -----------------------------------------------------------------


def plain_collocations(rows, least=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            own = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in (1, 2, 3):
                f.update((lang, tuple(own[i : i + size])) for i in range(len(own) - size + 1))
    often = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            often[lang, p] = min(
                (int(Fraction(10**6 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k) for k in range(1, len(p))
            )
    inside = {
        (lang, q) for lang, p in often if len(p) == 3 for q in (p[:2], p[1:])
        if 100 * f[lang, p] >= share * f[lang, q]
    }
    out = []
    for lang in n:
        own = [(p, *often[x, p]) for x, p in often if x == lang and (x, p) not in inside]
        own.sort(key=lambda r: (-r[1], -f[lang, r[0]], b" ".join(r[0])))
        for rank, (p, score, k) in enumerate(own[:top], 1):
            out.append((
                lang, rank, b" ".join(p).decode(), f[lang, p], f[lang, p[:k]], f[lang, p[k:]], n[lang], score,
            ))
    return sorted(out)


OPTIONS = [{}, {"every": 1}, {"every": 3, "bucket_bytes": 300}, {"least": 3, "top": 7}, {"every": 10**6}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_collocations_equal_brute_force(documents, edge_rows, spark, options):
    rng = random.Random(7)
    words = ["a", "B", "c", "é", "d-e", "\x1c", "x y"]
    signs = [" ", " ", " ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    made = ["".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = edge_rows + [(200 + i, t, rng.choice(["en", "xx", None, "und"]), None) for i, t in enumerate(made)]
    rows += [(400 + i, "the same words again and again in one long piece without a sign " * 3, "en", None) for i in range(30)]
    docs = documents(rows).withColumns({c: F.lit(c) for c in CLASHING})
    got = sorted(tuple(r) for r in collocations.collocations(docs, **options).collect())
    limits = {k: v for k, v in options.items() if k in ("least", "top")}
    assert got == plain_collocations([(r[2], r[1]) for r in rows], **limits)
    assert got


def test_small_slices_give_the_same(documents, spark, monkeypatch):
    rows = [(r.lang, r.text) for r in table(spark, SF, "documents").collect()]
    docs = documents([(i, t, lang, None) for i, (lang, t) in enumerate(rows)]).repartition(3)
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == plain_collocations(rows)


def test_no_documents_no_phrases(documents):
    for rows in ([], [(1, None, None, None), (2, "", "en", None), (3, " .,\n", "en", None)]):
        assert collocations.collocations(documents(rows)).collect() == []


def test_scores_are_exact_past_64_bits(spark):
    """Frequencies whose products pass 64 bits."""
    a, left, right = 7 * 10**14 + 3, 9 * 10**14 + 1, 8 * 10**14 + 7
    found = spark.createDataFrame(
        [("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right), ("en", None, 0, 10**15)],
        collocations.FREQUENT_SQL,
    )
    (row,) = collocations.scored(found).collect()
    assert row.score == 10**6 * a * a // (left * right) and (row.l, row.r) == (left, right)


def test_a_parse_owns_every_phrase_once():
    text = ("one two three four five six seven one two three, eight nine. " * 50).encode()
    for every in (1, 2, 5, 100):
        own = collocations.chunks(collocations.tokens([text]), every)
        words, found = collocations.phrases(list(own), collocations.np.array(list(own.values())))
        names = words.names.to_pylist()
        got = Counter()
        for columns, n in found:
            for *ids, count in zip(*columns, n):
                got[b" ".join(names[i] for i in ids)] += int(count)
        want = Counter()
        for piece in re.split(rb"[.,]", text):
            w = piece.split()
            want.update(b" ".join(w[i : i + s]) for s in (1, 2, 3) for i in range(len(w) - s + 1))
        assert got == want


def test_many_words_do_not_fit_one_number():
    rng = collocations.np.random.default_rng(3)
    columns = [rng.integers(0, 50, 400) for _ in range(3)]
    count = rng.integers(1, 9, 400)
    narrow = collocations.distinct(columns, count, 50)
    wide = collocations.distinct(columns, count, 1 << 40)
    for a, b in zip([*narrow[0], narrow[1]], [*wide[0], wide[1]]):
        assert a.tolist() == b.tolist()
