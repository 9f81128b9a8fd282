"""Aggregate first, join second.

Every chart, KPI and the health table is an aggregate over the enriched
facts. Joining the row-level facts first would shuffle every reading on
machine_id when the dimension is too large to broadcast, and one hot
machine would land in one task. Instead the facts are reduced to partial
aggregates at the machine grain (plus the chart key), which Spark computes
map-side before its only shuffle of the facts, and only those rows meet
the dimension.

This is exact, not an approximation. A machine id that occurs k times in
the dimension repeats each of its readings k times in the plain join; here
the dimension is also reduced first, to (machine_id, attributes, copies),
and the additive partials are multiplied by ``copies``: sums and counts
scale with the repetition, min / max do not change. So a machine id with a
huge number of copies costs one row, not copies x partials. Averages are
carried as (sum, count) and divided at the end.

The partial aggregates come either from the row-level readings or, when
``Tables.rollup`` is set, from the stored rollup at (machine_id, date,
status), which is re-aggregated the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.operators.enrich import enrich, join_how
from plantlens.operators.filters import (
    Filters,
    filter_events,
    filter_machines,
    filter_readings,
)
from plantlens.tables import Tables

# Additive partial aggregates of the readings (also the rollup's columns).
SENSOR_SUMS = (
    "readings",
    "warnings",
    "criticals",
    "sum_temperature",
    "sum_vibration",
    "sum_pressure",
    "sum_energy",
)
ROLLUP_GRAIN = ("machine_id", "date", "status")
# Additive partial aggregates of the maintenance events (the event rollup's).
EVENT_SUMS = ("events", "downtime", "cost")
EVENT_ROLLUP_GRAIN = ("machine_id", "event_date", "maintenance_type")


def reading_sums() -> list[Column]:
    """Additive partial aggregates over row-level clean readings."""
    return [
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("status") == S.STATUS_WARNING).alias("warnings"),
        F.count_if(F.col("status") == S.STATUS_CRITICAL).alias("criticals"),
        F.sum("temperature_c").alias("sum_temperature"),
        F.sum("vibration_mm_s").alias("sum_vibration"),
        F.sum("pressure_bar").alias("sum_pressure"),
        F.sum("energy_kwh").alias("sum_energy"),
    ]


def reading_partials() -> list[Column]:
    """All partial aggregates over row-level readings (sums and date range)."""
    return reading_sums() + [
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ]


def sensor_measures(
    tables: Tables, filters: Filters, keys: Sequence[str] = ()
) -> DataFrame:
    """Fact-side filtered readings as partial aggregates at (machine_id, *keys)
    or finer.

    From row-level readings they are aggregated to exactly that grain
    (map-side partial aggregation, then one shuffle). Rollup rows are
    already aggregated and are returned as they are, only filtered: every
    consumer sums them again after the dimension join, so grouping them
    here first would cost an exchange and change nothing.
    """
    if tables.rollup is not None:
        rollup = tables.rollup.withColumns(
            {"first_date": F.col("date"), "last_date": F.col("date")}
        )
        source = filter_readings(rollup, filters)
        return source.select("machine_id", *keys, *SENSOR_SUMS, "first_date", "last_date")
    source = filter_readings(tables.sensors, filters)
    return source.groupBy("machine_id", *keys).agg(*reading_partials())


def event_sums() -> list[Column]:
    """Additive partial aggregates over row-level clean events."""
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum("downtime_minutes").alias("downtime"),
        F.sum("cost_eur").alias("cost"),
    ]


def event_measures(
    tables: Tables, filters: Filters, keys: Sequence[str] = ()
) -> DataFrame:
    """Fact-side filtered events as partial aggregates at (machine_id, *keys)
    or finer (event-rollup rows are returned as they are, see above)."""
    if tables.event_rollup is not None:
        source = filter_events(tables.event_rollup, filters)
        return source.select("machine_id", *keys, *EVENT_SUMS)
    source = filter_events(tables.maintenance, filters)
    return source.groupBy("machine_id", *keys).agg(*event_sums())


def machine_copies(machines: DataFrame) -> DataFrame:
    """The dimension with identical rows collapsed: distinct rows + ``copies``."""
    return machines.groupBy(*machines.columns).agg(F.count(F.lit(1)).alias("copies"))


def machine_repeats(machines: DataFrame) -> DataFrame:
    """Machine ids that the dimension holds more than once, with ``copies``."""
    counts = machines.groupBy("machine_id").agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def repeats(tables: Tables) -> DataFrame:
    """The stored ``machine_repeats``, or computed ones."""
    if tables.machine_repeats is not None:
        return tables.machine_repeats
    return machine_repeats(tables.machines)


def attach_machines(
    measures: DataFrame,
    tables: Tables,
    filters: Filters,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Partial aggregates joined with the filtered dimension.

    Only ``machine_id`` and the requested attributes of the dimension are
    read, reduced to one row per distinct (machine_id, attributes) with its
    number of copies (partial aggregation, so a hot id is combined before
    the shuffle) -- or taken from ``Tables.machine_copies`` when the
    aggregate layer has it. Left join without a dimension filter (unknown
    machines keep NULL attributes and count once), inner join with one.
    Additive columns come out multiplied by the copies; a machine id may
    keep several rows (one per variant), so callers group by what they need.

    Without attributes and without a dimension filter only the repetition
    matters, so the join is with the repeated ids alone: a table that is
    usually empty and small enough for the planner to broadcast.
    """
    if not attributes and not filters.has_dimension_filter:
        machines = repeats(tables)
        if filters.machine_id is not None:
            machines = machines.where(F.col("machine_id") == filters.machine_id)
    elif tables.machine_copies is not None:
        # Already collapsed: a machine id keeps one row per distinct variant,
        # each weighted by its copies, so no aggregation is needed here.
        machines = filter_machines(tables.machine_copies, filters).select(
            "machine_id", *attributes, "copies"
        )
    else:
        machines = (
            filter_machines(tables.machines, filters)
            .groupBy("machine_id", *attributes)
            .agg(F.count(F.lit(1)).alias("copies"))
        )
    joined = enrich(measures, machines, join_how(filters))
    copies = F.coalesce(F.col("copies"), F.lit(1).cast("bigint"))
    additive = [c for c in measures.columns if c in SENSOR_SUMS + EVENT_SUMS]
    return joined.withColumns({c: F.col(c) * copies for c in additive}).drop("copies")


def average(total: str, count: str = "readings") -> Column:
    """Average from summed partials; NULL when there are no rows."""
    return F.sum(total) / F.sum(count)
