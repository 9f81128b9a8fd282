"""KPIs: one row of totals and averages for the current filters.

Two global aggregates, one per fact table, each over partial aggregates at
the machine grain, combined into a single-row DataFrame without a cross
join and without collecting anything to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions import alert_rate
from plantlens.operators.enrich import NO_FILTERS
from plantlens.operators.filters import Filters, filter_readings
from plantlens.operators.measures import (
    attach_machines,
    average,
    event_measures,
    sensor_measures,
)
from plantlens.tables import Tables


def maintenance_totals(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """One row: total downtime (minutes) and cost; 0 when there are no events."""
    events = attach_machines(event_measures(tables, filters), tables, filters)
    return events.agg(
        F.coalesce(F.sum("downtime"), F.lit(0).cast("bigint")).alias("total_downtime"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_maintenance_cost"),
    )


def kpis(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """The KPI row; machines are those seen in the filtered readings.

    After the join a machine id can repeat (one row per dimension variant);
    re-grouping by machine_id -- free, the join output is already hashed on
    it -- makes the machine count a plain count, not a distinct count.
    """
    sums = ("readings", "warnings", "criticals", "sum_temperature", "sum_vibration")
    readings = (
        attach_machines(sensor_measures(tables, filters), tables, filters)
        .groupBy("machine_id")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    sensor = readings.agg(
        F.count(F.lit(1)).alias("total_machines"),
        F.coalesce(F.sum("readings"), F.lit(0).cast("bigint")).alias("total_readings"),
        F.coalesce(F.sum("warnings"), F.lit(0).cast("bigint")).alias("warning_events"),
        F.coalesce(F.sum("criticals"), F.lit(0).cast("bigint")).alias("critical_events"),
        average("sum_temperature").alias("average_temperature"),
        average("sum_vibration").alias("average_vibration"),
    )
    # Each one-row aggregate fills its own columns; the union of the two rows
    # collapses to one with max() per column. AQE runs the stages of both
    # branches at the same time (a scalar subquery would wait for the
    # sensor stages), and there is no cross join.
    both = sensor.unionByName(maintenance_totals(tables, filters), allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return row.select(
        "total_machines",
        "total_readings",
        "warning_events",
        "critical_events",
        "average_temperature",
        "average_vibration",
        "total_downtime",
        "total_maintenance_cost",
        alert_rate(
            F.col("warning_events"), F.col("critical_events"), F.col("total_readings")
        ).alias("alert_rate"),
        (F.col("total_downtime") / 60).alias("downtime_hours"),
    )


def date_bounds(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """One row: first and last reading date (NULL when there are none).

    Without a dimension filter the left join keeps every reading at least
    once, and min / max ignore repetition, so the join is skipped; and
    every reading has a rollup row of its date, so the rollup (far smaller)
    is read when there is one.
    """
    if not filters.has_dimension_filter:
        source = tables.rollup if tables.rollup is not None else tables.sensors
        readings = filter_readings(source, filters)
        return readings.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    partials = attach_machines(sensor_measures(tables, filters), tables, filters)
    return partials.agg(
        F.min("first_date").alias("min_date"), F.max("last_date").alias("max_date")
    )


def resolve_date_range(
    tables: Tables, filters: Filters, bounds: DataFrame | None = None
) -> Filters:
    """The dashboard's default: without a complete date range, use the full
    bounds of the sensor data. The bounds stay in Spark as scalar
    subqueries, so maintenance events outside them are dropped by the
    maintenance filter without a round trip through the driver. Readings
    need no filter then, and without any reading no event is dropped.

    ``bounds`` may be a stored ``date_bounds`` result (one row), which
    saves the scan of the readings."""
    if filters.has_date_range:
        return filters
    if bounds is None:
        bounds = date_bounds(tables)
    return Filters(
        factory=filters.factory,
        production_line=filters.production_line,
        model=filters.model,
        machine_id=filters.machine_id,
        status=filters.status,
        start_date=bounds.select("min_date").scalar(),
        end_date=bounds.select("max_date").scalar(),
        full_range=True,
    )
