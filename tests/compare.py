"""Spark-vs-DuckDB comparison used by the oracle tests and by hand.

Rows are compared as multisets after sorting columns by name. Values are
compared exactly (floats by their repr), since the bound test tables keep
every sum exact.
"""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, str, int)):
        return v if not isinstance(v, dt.date) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql: str):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return cols, sorted(rows, key=_key)


def compare(df, con, sql: str) -> tuple[bool, str]:
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duckdb={dcols}"
    if len(srows) != len(drows):
        return False, f"row counts differ: spark={len(srows)} duckdb={len(drows)}"
    for a, b in zip(srows, drows):
        if a != b:
            return False, f"first differing row: spark={a} duckdb={b}"
    return True, f"{len(srows)} rows equal"
