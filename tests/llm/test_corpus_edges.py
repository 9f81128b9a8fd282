"""Null, empty, long, tied and repeated input; empty tables; clashing
column names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plantlens.llm import (
    decontaminate,
    fill_middle,
    language_id,
    license_scan,
    line_dedup,
    lm_score,
    mixing,
    ngram_join,
    pii,
    quality_classifier,
    quality_rules,
    toxicity,
)

CLASHING = ("row", "doc", "size", "n", "n_words", "spans", "label", "k1", "gram", "score", "word", "kept", "rate")


def operators(labels, benchmark):
    return {
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "mixing": mixing.mix,
        "line_dedup": line_dedup.digest,
        "ngram_join": ngram_join.ngram_join,
        "license_scan": license_scan.license_scan,
        "quality_rules": quality_rules.quality_rules,
        "lm_score": lm_score.lm_scores,
        "quality": lambda d: quality_classifier.quality(d, labels),
        "contamination": lambda d: decontaminate.digest(decontaminate.contamination(d, benchmark)),
        "pii": lambda d: pii.digest(pii.personal_data(d)),
        "language_id": language_id.languages,
        "fill_middle": lambda d: fill_middle.digest(fill_middle.fill_middle(d)),
    }


NAMES = list(operators(None, None))


@pytest.fixture(scope="module")
def tables(documents, labels, benchmark, edge_rows):
    own = labels([(3, 1, 0), (3, 1, 0), (4, 0, 1), (9, 1, None), (10, 0, 1), (None, 1, 1), (6, 1, 0)])
    items = benchmark([(1, "word1 the thing word2"), (1, "word1 the thing word2"), (2, None), (None, ""), (3, "café")])
    return documents(edge_rows), own, items


@pytest.mark.parametrize("name", NAMES)
def test_each_row_has_a_result(tables, name):
    docs, own, items = tables
    rows = operators(own, items)[name](docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    same = [tuple(r) for r in rows if r.doc_id == 3]
    assert len(same) == 2 and (name == "mixing" or same[0] == same[1])


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(tables, name):
    docs, own, items = tables
    nothing = operators(own.limit(0), items.limit(0))[name]
    assert nothing(docs.limit(0)).collect() == []
    assert len(nothing(docs).collect()) == docs.count()


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_change_nothing(tables, name):
    docs, own, items = tables
    more = docs.withColumns({c: F.lit(c) for c in CLASHING})
    run = operators(own, items)[name]
    key = [c for c in run(docs).columns if "score" not in c and c not in ("base", "spans")]
    plain, clashing = (sorted(map(str, run(d).select(key).collect())) for d in (docs, more))
    assert plain == clashing


def test_stages_keep_the_columns(spark, tables, tmp_path):
    docs, own, items = tables
    own.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for case in (docs, docs.withColumns({c: F.lit(c) for c in CLASHING}), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, case, str(tmp_path))
            assert out.schema.simpleString() == case.schema.simpleString()
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, case, str(tmp_path)).count() == case.count()
