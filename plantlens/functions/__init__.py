"""Column expressions shared by the operators (all JVM-side built-ins)."""

from plantlens.functions.exprs import (
    alert_rate,
    alert_rate_pct,
    as_date,
    as_timestamp,
    health_score,
    health_status,
    present,
)

__all__ = [
    "alert_rate",
    "alert_rate_pct",
    "as_date",
    "as_timestamp",
    "health_score",
    "health_status",
    "present",
]
