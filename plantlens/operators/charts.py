"""Chart tables: daily trend, per-machine, alerts, status, type, factory.

Each is a lazy DataFrame; the caller collects or writes it. All start
from partial aggregates at the machine grain (``measures``), so the row-
level facts are shuffled at most once, already reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.operators.enrich import NO_FILTERS
from plantlens.operators.filters import Filters
from plantlens.operators.measures import (
    attach_machines,
    average,
    event_measures,
    sensor_measures,
)
from plantlens.tables import Tables


def daily_trend(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    partials = attach_machines(sensor_measures(tables, filters, ["date"]), tables, filters)
    daily = partials.groupBy("date").agg(
        average("sum_temperature").alias("average_temperature"),
        average("sum_vibration").alias("average_vibration"),
        F.sum("sum_energy").alias("total_energy"),
    )
    return daily.orderBy(F.col("date").asc())


def machine_performance(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    partials = attach_machines(sensor_measures(tables, filters), tables, filters)
    return (
        partials.groupBy("machine_id")
        .agg(
            average("sum_temperature").alias("average_temperature"),
            average("sum_vibration").alias("average_vibration"),
            average("sum_pressure").alias("average_pressure"),
            F.sum("readings").alias("number_of_readings"),
        )
        .orderBy(F.col("average_temperature").desc(), F.col("machine_id").asc())
    )


def alerts_by_machine(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """WARNING and CRITICAL readings per machine, for machines with any.

    The two pivot columns come from conditional counts in the one
    aggregate, instead of a (machine, status) count followed by a pivot.
    """
    partials = sensor_measures(tables, filters).filter(
        (F.col("warnings") + F.col("criticals")) > 0
    )
    return (
        attach_machines(partials, tables, filters)
        .groupBy("machine_id")
        .agg(F.sum("warnings").alias("WARNING"), F.sum("criticals").alias("CRITICAL"))
        .orderBy(F.col("CRITICAL").desc(), F.col("WARNING").desc(), F.col("machine_id").asc())
    )


def status_distribution(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """Readings per status; NULL status is a group of its own."""
    partials = attach_machines(sensor_measures(tables, filters, ["status"]), tables, filters)
    counts = partials.groupBy("status").agg(F.sum("readings").alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("status").asc())


def maintenance_by_type(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    partials = attach_machines(
        event_measures(tables, filters, ["maintenance_type"]), tables, filters
    )
    by_type = partials.groupBy("maintenance_type").agg(
        F.sum("cost").alias("maintenance_cost"),
        F.sum("downtime").alias("downtime_minutes"),
        F.sum("events").alias("maintenance_events"),
    )
    return by_type.orderBy(F.col("maintenance_cost").desc(), F.col("maintenance_type").asc()
    )


def downtime_by_factory(tables: Tables, filters: Filters = NO_FILTERS) -> DataFrame:
    """Downtime and cost per factory; unknown machines form the NULL group."""
    partials = attach_machines(event_measures(tables, filters), tables, filters, ["factory"])
    by_factory = partials.groupBy("factory").agg(
        F.sum("downtime").alias("downtime_minutes"),
        F.sum("cost").alias("maintenance_cost"),
    )
    return by_factory.orderBy(F.col("downtime_minutes").desc(), F.col("factory").asc()
    )


def chart_data(tables: Tables, filters: Filters = NO_FILTERS) -> dict[str, DataFrame]:
    """All six chart tables, lazily."""
    return {name: chart(tables, filters) for name, chart in CHARTS.items()}


CHARTS = {
    "daily_trend": daily_trend,
    "machine_performance": machine_performance,
    "alerts": alerts_by_machine,
    "status_distribution": status_distribution,
    "maintenance_type": maintenance_by_type,
    "factory_downtime": downtime_by_factory,
}


# Two-column series the dashboard plots from the chart tables.
SERIES = {
    "daily_temperature": ("daily_trend", "date", "average_temperature"),
    "daily_vibration": ("daily_trend", "date", "average_vibration"),
    "daily_energy": ("daily_trend", "date", "total_energy"),
    "machine_temperature": ("machine_performance", "machine_id", "average_temperature"),
    "machine_vibration": ("machine_performance", "machine_id", "average_vibration"),
    "cost_by_type": ("maintenance_type", "maintenance_type", "maintenance_cost"),
    "downtime_by_factory": ("factory_downtime", "factory", "downtime_minutes"),
}


def series(tables: Tables, name: str, filters: Filters = NO_FILTERS) -> DataFrame:
    """One plotted series (x, y) from its chart table."""
    chart, x, y = SERIES[name]
    return CHARTS[chart](tables, filters).select(x, y)
