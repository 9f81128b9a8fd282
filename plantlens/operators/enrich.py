"""Enrichment: facts left-joined with the machine dimension on machine_id.

Readings or events of a machine that is not in the (clean) dimension keep
NULL machine attributes. A machine id present k times in the dimension
repeats each of its facts k times -- the plain semantics of the join,
kept on purpose (``plans.checks.duplicate_machines`` reports such ids).

Join strategy is left to the planner: the dimension is broadcast only when
its size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
may switch at run time with real sizes); otherwise both sides are shuffled
on machine_id and AQE splits skewed key partitions. No broadcast hint is
forced, since the dimension's size is not bounded by the library. Over
bucketed tables (``plans.bucketed``) the join needs no shuffle, and only the
counted rows of hot machines are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.operators.filters import (
    Filters,
    filter_events,
    filter_machines,
    filter_readings,
)
from plantlens.tables import Tables

NO_FILTERS = Filters()


def join_how(filters: Filters) -> str:
    """A dimension filter rejects facts without a machine: inner join."""
    return "inner" if filters.has_dimension_filter else "left"


def enrich(facts: DataFrame, machines: DataFrame, how: str = "left") -> DataFrame:
    """``facts`` joined with ``machines`` on machine_id (one key column)."""
    return facts.join(machines, on="machine_id", how=how)


def _enrich_rows(facts: DataFrame, tables: Tables, filters: Filters) -> DataFrame:
    """Filtered facts with the filtered machines. Facts of hot machines are
    joined apart; their dimension rows are broadcast where they have been
    counted and are few, so that the facts stay where they are scanned."""
    machines, how = filter_machines(tables.machines, filters), join_how(filters)
    if not tables.hot or filters.machine_id is not None:
        return enrich(facts, machines, how)
    is_hot = F.col("machine_id").isin(*tables.hot)
    few = machines.where(is_hot)
    return enrich(facts.where(~is_hot), machines.where(~is_hot), how).unionByName(
        enrich(facts.where(is_hot), few.hint("broadcast") if tables.hot_is_small else few, how)
    )


def enrich_sensors(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """Filtered sensor readings with their machine attributes."""
    return _enrich_rows(filter_readings(tables.sensors, filters), tables, filters)


def enrich_maintenance(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """Filtered maintenance events with their machine attributes."""
    return _enrich_rows(filter_events(tables.maintenance, filters), tables, filters)


def prepare(tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean tables -> (enriched readings, enriched events, clean machines)."""
    return enrich_sensors(tables), enrich_maintenance(tables), tables.machines
