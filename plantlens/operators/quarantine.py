"""Cleaning that says what it leaves out.

``judged`` does what the clean step does, and keeps every row: the parsed
columns, whether the row is accepted, and its defects as (column, problem,
value as it was read). Problems are

* ``missing``: no value in a required column,
* ``unreadable``: text that is not of the column's type,
* ``not a number``: NaN in a required column.

A defect of a required column rejects the row, so the accepted rows are
just the rows of ``clean``. An unreadable value of another column only
becomes NULL, as there, and is listed. Rows of a text file with another
number of cells than its header have the defect ``row: cells`` (with the
whole line as the value); whether they are accepted is up to their columns.

All of it is one projection, so accepted and rejected rows and the counts
(``measures``, for ``DataFrame.observe``) come from a single scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens import schemas as S
from plantlens.functions import as_date, as_timestamp
from plantlens.sources.csv import MALFORMED, cell
from plantlens.sources.versions import ACCEPTED, DEFECTS

MISSING, UNREADABLE, NAN = "missing", "unreadable", "not a number"
CELLS = "cells"


@dataclass(frozen=True)
class Rules:
    """What the clean step asks of one table."""

    schema: T.StructType
    required: tuple[str, ...]
    parsed: str  # the column with a date or timestamp
    parse: Callable[[DataFrame, str], Column]
    day: str | None  # the column the curated table is kept by
    derived: tuple[tuple[str, str], ...] = ()  # (date column, timestamp column)


RULES = {
    "sensors": Rules(S.SENSOR_CSV, S.SENSOR_REQUIRED, "timestamp", as_timestamp, "date", (("date", "timestamp"),)),
    "machines": Rules(S.MACHINE_CSV, S.MACHINE_REQUIRED, "install_date", as_date, None),
    "maintenance": Rules(S.MAINTENANCE_CSV, S.MAINTENANCE_REQUIRED, "event_date", as_date, "event_date"),
}


def _value(raw: DataFrame, rules: Rules, name: str) -> Column:
    """A column as the clean step reads it."""
    if name == rules.parsed:
        return rules.parse(raw, name)
    declared = next((f for f in rules.schema if f.name == name), None)
    if declared is not None and isinstance(raw.schema[name].dataType, T.StringType):
        return cell(declared)
    if name == S.READING_ID:
        return F.col(name).try_cast("bigint")
    return F.col(name)


def problems(raw: DataFrame, rules: Rules) -> dict[str, Column]:
    """Per column the problem of its value, or null."""
    out = {}
    for name in raw.columns:
        if name == MALFORMED:
            continue
        value, must = _value(raw, rules, name), name in rules.required
        kind = raw.select(value.alias(name)).schema[name].dataType
        found = F.when(F.col(name).isNotNull() & value.isNull(), F.lit(UNREADABLE))
        if must:
            found = found.when(value.isNull(), F.lit(MISSING))
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                found = found.when(F.isnan(value), F.lit(NAN))
        out[name] = found
    if MALFORMED in raw.columns:
        out["row"] = F.when(F.col(MALFORMED).isNotNull(), F.lit(CELLS))
    return out


def mark(name: str) -> str:
    """The column of ``marked`` with the problem of a column."""
    return f"_problem_{name}"


def marked(raw: DataFrame, table: str) -> DataFrame:
    """``raw`` with the problem of each column in a column of its own, and
    ``accepted``."""
    found = problems(raw, RULES[table])
    with_marks = raw.select("*", *(p.alias(mark(name)) for name, p in found.items()))
    rejected = reduce(or_, (F.col(mark(c)).isNotNull() for c in RULES[table].required))
    return with_marks.withColumn(ACCEPTED, ~rejected)


def _kinds(names: list[str], table: str) -> list[tuple[str, str]]:
    """(column, problem) that can occur."""
    required = RULES[table].required
    return [
        (name, kind)
        for name in names
        for kind in ((CELLS,) if name == "row" else (MISSING, UNREADABLE, NAN) if name in required else (UNREADABLE,))
    ]


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ACCEPTED)).alias(ACCEPTED)]


def measures(with_marks: DataFrame, table: str) -> list[Column]:
    """Counts for ``DataFrame.observe`` over ``marked`` rows: rows, accepted
    rows, and rows per column and problem ("column: problem")."""
    names = [c.removeprefix(mark("")) for c in with_marks.columns if c.startswith(mark(""))]
    return _totals() + [
        F.count_if(F.col(mark(name)) == kind).alias(f"{name}: {kind}") for name, kind in _kinds(names, table)
    ]


def recounted(rows: DataFrame, table: str, names: list[str]) -> DataFrame:
    """The row of ``measures`` from ``judged`` rows; ``names``: the columns
    that were judged."""
    found = F.transform(DEFECTS, lambda d: F.concat_ws(": ", d["column"], d["problem"]))
    return rows.withColumn("found", found).agg(*_totals(), *(
        F.count_if(F.array_contains("found", f"{name}: {kind}")).alias(f"{name}: {kind}")
        for name, kind in _kinds(names, table)
    ))


def parsed(with_marks: DataFrame, table: str) -> DataFrame:
    """The clean columns of all rows, ``accepted`` and ``defects``."""
    rules = RULES[table]
    names = [c for c in with_marks.columns if c != ACCEPTED and c != MALFORMED and not c.startswith(mark(""))]
    marks = [c for c in with_marks.columns if c.startswith(mark(""))]
    listed = [
        F.when(
            F.col(m).isNotNull(),
            F.struct(
                F.lit(m.removeprefix(mark(""))).alias("column"), F.col(m).alias("problem"),
                F.col(MALFORMED if m == mark("row") else m.removeprefix(mark(""))).cast("string").alias("value"),
            ),
        )
        for m in marks
    ]
    defects = F.array_compact(F.array(*listed)).alias(DEFECTS)
    typed = with_marks.select(*(_value(with_marks, rules, c).alias(c) for c in names), ACCEPTED, defects)
    for day, moment in rules.derived:
        typed = typed.withColumn(day, F.to_date(moment))
    return typed


def judged(raw: DataFrame, table: str) -> DataFrame:
    """All rows of ``raw`` (text cells or typed) with their verdict."""
    return parsed(marked(raw, table), table)


def accepted(rows: DataFrame) -> DataFrame:
    """The clean rows of ``judged``."""
    return rows.where(ACCEPTED).drop(ACCEPTED, DEFECTS)


def quarantined(rows: DataFrame) -> DataFrame:
    """The rejected rows of ``judged`` with their defects."""
    return rows.where(~F.col(ACCEPTED)).drop(ACCEPTED)
