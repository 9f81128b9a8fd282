"""Library code stays distributed: no driver collects, no forced broadcast,
no local checkpoint, no Python UDF."""

from __future__ import annotations

import pathlib
import re

import pytest

PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "plantlens"
FORBIDDEN = {
    r"\.collect\(": "collect to the driver",
    r"\.toPandas\(": "collect to the driver",
    r"\.toLocalIterator\(": "collect to the driver",
    r"localCheckpoint": "local checkpoint",
    r"\bbroadcast\(": "forced broadcast",
    r"@(F\.)?(pandas_)?udf\b|\budf\(": "Python UDF",
    r"\.rdd\b": "RDD API",
    r"crossJoin": "cross join",
}


# plantlens/llm has rules of its own (tests/llm).
FILES = sorted(p for p in PACKAGE.rglob("*.py") if p.parent.name != "llm")


@pytest.mark.parametrize("path", FILES, ids=lambda p: p.name)
def test_no_forbidden_calls(path):
    text = path.read_text()
    for pattern, why in FORBIDDEN.items():
        assert not re.search(pattern, text), f"{path.name}: {why} ({pattern})"
