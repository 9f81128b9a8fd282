"""Registered queries against their SQL, the pipeline, and rules for the
source of this subpackage."""

from __future__ import annotations

import glob
import math
import os
import re

import brute
import duckdb
import pytest

import corpus_pipeline
from plantlens.llm import registry
from plantlens.llm.common import table

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    got = registry.QUERIES[name](spark, SF)
    with duckdb.connect() as db:
        db.execute("set threads to 4")
        for t in ("documents", "benchmark", "labels"):
            db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        found = db.execute(registry.ORACLE_SQL[name])
        names = [c[0] for c in found.description]
        want = [dict(zip(names, r)) for r in found.fetchall()]
    assert sorted(got.columns) == sorted(names)
    rows = sorted(tuple(str(plain(r[c])) for c in sorted(names)) for r in got.collect())
    assert rows == sorted(tuple(str(plain(r[c])) for c in sorted(names)) for r in want)


def test_queries_without_sql_run(spark):
    for name in set(registry.QUERIES) - set(registry.ORACLE_SQL):
        assert registry.QUERIES[name](spark, SF).count() == table(spark, SF, "documents").count()


def test_stages_against_brute_force(spark):
    """Every stage on what the one before it kept."""
    docs = table(spark, SF, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]

    def texts(df):
        return {r.doc_id: r.text for r in df.collect()}

    def run(name):
        return corpus_pipeline.written(stages[name](spark, docs, SF), "test")

    before = texts(docs)
    docs = run("quality classifier")
    after = texts(docs)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert set(after) < set(before) and all(after[d] == before[d] for d in after)
    assert sum(labels.get(d) == 1 for d in after) >= 0.97 * sum(q == 1 for q in labels.values())

    before, docs = after, run("line dedup")
    after, want = texts(docs), brute.line_dedup(list(before.items()))
    assert {d: brute.sha(t) for d, t in after.items()} == {d: w[2] for d, w in want.items()}

    before, docs = after, run("n-gram Jaccard join")
    after = texts(docs)
    assert set(after) == {c for _, c in brute.components(list(before.items()), 5, 80).values()}

    before, docs = after, run("benchmark decontamination")
    after = texts(docs)
    assert set(after) == set(before)
    for d, (_, hit, _) in brute.contamination(list(before.items()), bench).items():
        left = [w for k, w in enumerate(brute.item_words(before[d])) if k not in hit]
        assert brute.item_words(after[d]) == left and (hit or after[d] == before[d])

    mixed = run("mixing sources to target weights").collect()
    assert {r.doc_id: r["size"] for r in mixed} == {d: len(brute.words(t)) for d, t in after.items()}
    assert sum(r.taken for r in mixed) == pytest.approx(1.5 * sum(r["size"] for r in mixed), abs=len(mixed))


NATIVE = ("mixing.py", "license_scan.py", "pii.py", "boosting.py")


def test_source_rules():
    files = [f"{ROOT}/corpus_pipeline.py", *glob.glob(f"{ROOT}/plantlens/llm/*.py")]
    for path in files:
        with open(path) as f:
            text = f.read()
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|except ImportError|\.sample\(", text), path
        if os.path.basename(path) in NATIVE:
            assert not re.search(r"pandas|pyarrow|InArrow|InPandas|\budf\b|numpy", text), path
