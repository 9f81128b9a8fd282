from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text) or longer rows."""

    def make(rows):
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and long texts, ties, repeated rows."""
    line = "A line that several documents share."
    long = " ".join(f"word{i % 977} the Thing" for i in range(40_000))
    return [
        (None, None, None, None),
        (None, "a text without an id, which is also a text", "en", None),
        (1, "", "en", "b"),
        (2, None, "en", "b"),
        (3, f"{line}\nand one of its own", "en", "a"),
        (3, f"{line}\nand one of its own", "en", "a"),
        (4, f"  {line.upper()}\t\nanother one here", None, "a"),
        (5, " \t\n\x0b\x0c\r ", "de", "c"),
        (6, long, "en", "a"),
        (7, long + " end", "en", ""),
        (8, "x" * 100_000, "fr", "a"),
        (9, "MIT License�   café İ +49 30 901820 a@b.cc 1.2.3.4 4111 1111 1111 1111", "fr", "a"),
        (10, "\n".join([line] * 50), "en", "a"),
    ]
