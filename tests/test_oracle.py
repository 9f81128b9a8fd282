"""Every registered query against its DuckDB oracle on the bound sf0.01 tables."""

from __future__ import annotations

import pytest
from compare import compare, duck
from plants import SF01

from plantlens.registry import ENTRIES

WITH_SQL = sorted(name for name, e in ENTRIES.items() if e.sql is not None)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    entry = ENTRIES[name]
    ok, msg = compare(entry.run(spark, SF01), con, entry.sql)
    assert ok, f"{name}: {msg}"


def test_every_query_has_an_oracle():
    rows_only = {name for name, e in ENTRIES.items() if e.sql is None}
    assert rows_only == set()
