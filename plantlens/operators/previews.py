"""Row previews: latest readings, maintenance history, machine master data.

The "latest n" tables are top-k queries (``TakeOrderedAndProject``): each
task keeps its best n rows and one task merges them, so no full sort and
no shuffle of the facts. The top-k runs on the bare facts first and only
the n survivors are joined with the dimension; a second top-k then cuts
the joined rows back to n. This is exact because every surviving fact
keeps at least one joined row: without a dimension filter the join is a
left join, and with one the facts are first semi-joined with the distinct
machine ids that pass it (broadcast when the planner finds that id list
small, which a dimension filter usually makes it).

With the aggregate layer present the scan itself is cut down too: the
rollup knows how many qualifying rows each day holds, so the newest day
from which at least n rows exist is a small query over it, and the facts
are read from that day on -- partition pruning on the curated layer's
date folders, evaluated at run time. Counting facts without the
dimension's repetition can only undercount the joined rows, so the n
newest joined rows always lie within the kept days: the result is exact.

Ties are broken by every column that can differ, so the n rows are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.operators.enrich import NO_FILTERS, enrich, join_how
from plantlens.operators.filters import (
    Filters,
    filter_events,
    filter_machines,
    filter_readings,
)
from plantlens.tables import Tables


def _order(df: DataFrame, first: list[Column], keys: tuple[str, ...]) -> list[Column]:
    rest = [F.col(k).asc() for k in keys if k in df.columns]
    return first + rest


def _recent_days(counts: DataFrame, day: str, rows: str, n: int) -> Column:
    """Predicate on ``day``: true from the newest day on which ``counts``
    reaches ``n`` rows (a scalar subquery); always true when it holds fewer.

    The running total runs over one row per day -- a few thousand rows even
    for years of data -- in a single task.
    """
    per_day = counts.groupBy(day).agg(F.sum(rows).alias("rows"))
    newest_first = Window.orderBy(F.col(day).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cutoff = (
        per_day.withColumn("running", F.sum("rows").over(newest_first))
        .filter(F.col("running") >= n)
        .agg(F.max(day))
        .scalar()
    )
    return F.coalesce(F.col(day) >= cutoff, F.lit(True))


def _latest(
    facts: DataFrame,
    machines: DataFrame,
    filters: Filters,
    first: list[Column],
    fact_keys: tuple[str, ...],
    n: int,
    counts: DataFrame | None = None,
    day: str = "date",
    rows: str = "readings",
) -> DataFrame:
    ids = machines.select("machine_id").distinct() if filters.has_dimension_filter else None
    if ids is not None:
        facts = facts.join(ids, on="machine_id", how="left_semi")
    if counts is not None:
        if ids is not None:
            counts = counts.join(ids, on="machine_id", how="left_semi")
        facts = facts.filter(_recent_days(counts, day, rows, n))
    facts = facts.orderBy(*_order(facts, first, fact_keys)).limit(n)
    joined = enrich(facts, machines, join_how(filters))
    return joined.orderBy(*_order(joined, first, fact_keys + S.MACHINE_ATTRIBUTES)).limit(n)


def latest_readings(
    tables: Tables, filters: Filters = NO_FILTERS, n: int = S.LATEST_ROWS
) -> DataFrame:
    """The ``n`` newest enriched readings."""
    counts = None if tables.rollup is None else filter_readings(tables.rollup, filters)
    return _latest(
        filter_readings(tables.sensors, filters),
        filter_machines(tables.machines, filters),
        filters,
        [F.col("timestamp").desc()],
        ("machine_id", S.READING_ID, "status", "temperature_c", "pressure_bar",
         "vibration_mm_s", "energy_kwh"),
        n,
        counts,
        "date",
        "readings",
    )


def maintenance_history(
    tables: Tables, filters: Filters = NO_FILTERS, n: int = S.LATEST_ROWS
) -> DataFrame:
    """The ``n`` most recent enriched maintenance events."""
    counts = (
        None if tables.event_rollup is None else filter_events(tables.event_rollup, filters)
    )
    return _latest(
        filter_events(tables.maintenance, filters),
        filter_machines(tables.machines, filters),
        filters,
        [F.col("event_date").desc()],
        ("event_id", "machine_id", "maintenance_type", "downtime_minutes", "cost_eur",
         "technician_id", "issue"),
        n,
        counts,
        "event_date",
        "events",
    )


def machine_master(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """The filtered machine dimension, all columns, by machine_id (no limit:
    write it, do not collect it)."""
    return filter_machines(tables.machines, filters).orderBy("machine_id")
