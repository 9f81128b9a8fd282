"""Operators: each takes ``Tables`` (+ ``Filters``) and returns a DataFrame."""

from plantlens.operators.charts import (
    alerts_by_machine,
    chart_data,
    daily_trend,
    downtime_by_factory,
    machine_performance,
    maintenance_by_type,
    series,
    status_distribution,
)
from plantlens.operators.clean import clean, clean_machines, clean_maintenance, clean_sensors
from plantlens.operators.enrich import enrich, enrich_maintenance, enrich_sensors, prepare
from plantlens.operators.filters import Filters
from plantlens.operators.health import (
    health_distribution,
    health_status_counts,
    machine_health,
    top_risk_machines,
)
from plantlens.operators.kpis import date_bounds, kpis, maintenance_totals, resolve_date_range
from plantlens.operators.options import machine_metadata, option_values, status_options
from plantlens.operators.previews import latest_readings, machine_master, maintenance_history

__all__ = [
    "Filters",
    "alerts_by_machine",
    "chart_data",
    "clean",
    "clean_machines",
    "clean_maintenance",
    "clean_sensors",
    "daily_trend",
    "date_bounds",
    "downtime_by_factory",
    "enrich",
    "enrich_maintenance",
    "enrich_sensors",
    "health_distribution",
    "health_status_counts",
    "kpis",
    "latest_readings",
    "machine_health",
    "machine_master",
    "machine_metadata",
    "machine_performance",
    "maintenance_by_type",
    "maintenance_history",
    "maintenance_totals",
    "option_values",
    "prepare",
    "resolve_date_range",
    "series",
    "status_distribution",
    "status_options",
    "top_risk_machines",
]
