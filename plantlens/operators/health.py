"""Machine health: a rule-based score per machine, its categories and views.

The score penalises 1 point per WARNING and 3 per CRITICAL reading, in
percent of the machine's readings, clamped at 0 and rounded to one digit;
the category is taken from the rounded score. Health ignores the status
filter: filtering to CRITICAL readings would otherwise mark every machine
as at risk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.functions import alert_rate_pct, health_score, health_status
from plantlens.operators.enrich import NO_FILTERS
from plantlens.operators.filters import Filters
from plantlens.operators.measures import (
    attach_machines,
    average,
    sensor_measures,
)
from plantlens.tables import Tables

HEALTH_KEYS = ("machine_id", "factory", "production_line", "model", "criticality")
RISK_COLUMNS = (
    "machine_id",
    "factory",
    "production_line",
    "model",
    "health_score",
    "alert_rate_pct",
    "warnings",
    "criticals",
)


def machine_health(tables: Tables, filters: Filters = NO_FILTERS, ordered: bool = True) -> DataFrame:
    """One row per (machine, attributes): counts, averages, score, category.

    Plan: readings -> partial aggregate by machine_id (one shuffle of
    partials) -> join the dimension's four attributes -> group by the five
    keys. The join output stays hash-partitioned on machine_id, which
    already clusters the five-key grouping, so that step adds no shuffle.
    """
    scoped = filters.without_status()
    partials = sensor_measures(tables, scoped)
    attached = attach_machines(partials, tables, scoped, HEALTH_KEYS[1:])
    counts = attached.groupBy(*HEALTH_KEYS).agg(
        F.sum("readings").alias("readings"),
        F.sum("warnings").alias("warnings"),
        F.sum("criticals").alias("criticals"),
        average("sum_temperature").alias("average_temperature"),
        average("sum_vibration").alias("average_vibration"),
        average("sum_pressure").alias("average_pressure"),
    )
    w, c, n = F.col("warnings"), F.col("criticals"), F.col("readings")
    health = counts.withColumn("alert_rate_pct", alert_rate_pct(w, c, n)).withColumn(
        "health_score", health_score(w, c, n)
    )
    health = health.withColumn("health_status", health_status(F.col("health_score")))
    if ordered:
        health = health.orderBy(F.col("health_score").asc(), F.col("machine_id").asc())
    return health


def health_status_counts(health: DataFrame) -> DataFrame:
    """One row: machines per category, 0 for a category that does not occur."""
    status = F.col("health_status")
    return health.agg(
        F.count_if(status == S.HEALTHY).alias("healthy"),
        F.count_if(status == S.WATCH).alias("watch"),
        F.count_if(status == S.AT_RISK).alias("at_risk"),
    )


def health_distribution(health: DataFrame) -> DataFrame:
    """Machines per category that occurs, most frequent first."""
    counts = health.groupBy("health_status").agg(F.count(F.lit(1)).alias("machines"))
    return counts.orderBy(F.col("machines").desc(), F.col("health_status").asc())


def top_risk_machines(health: DataFrame, n: int = S.TOP_RISK_ROWS) -> DataFrame:
    """The ``n`` lowest scores (ties by machine_id), as a top-k: each task
    keeps its best ``n`` rows and one task merges them."""
    return (
        health.orderBy(F.col("health_score").asc(), F.col("machine_id").asc())
        .limit(n)
        .select(*RISK_COLUMNS)
    )
