"""Shared scratch folder: read from the session, fresh per use."""

from __future__ import annotations

import os

import pytest

from plantlens.session import fresh_dir, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = shared_dir(spark)
    assert base == configured or configured is None and os.path.isdir(base) and shared_dir(spark) == base


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "local-cluster[2,1,1024]"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf = {}
        sparkContext = Context

    with pytest.raises(RuntimeError):
        shared_dir(Session)


def test_fresh_dirs_are_unique_and_below_the_shared_dir(spark):
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b
    assert a.startswith(shared_dir(spark)) and b.startswith(shared_dir(spark))
