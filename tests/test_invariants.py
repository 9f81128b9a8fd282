"""Cross-result invariants and the expected counts of the binding at sf0.01."""

from __future__ import annotations

import pytest
from plants import SF01
from pyspark.sql import functions as F

from plantlens.operators import (
    alerts_by_machine,
    date_bounds,
    downtime_by_factory,
    health_status_counts,
    kpis,
    machine_health,
    machine_performance,
    maintenance_by_type,
    status_distribution,
)
from plantlens.registry import tables


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, SF01)


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_binding_counts(t):  # FIXTURES.md, expected counts at sf0.01
    assert t.sensors.count() == 9785
    assert t.machines.count() == 1448
    assert t.maintenance.count() == 14851
    k = kpis(t).first()
    assert k["total_machines"] == 150
    assert (k["warning_events"], k["critical_events"]) == (612, 166)
    assert k["total_downtime"] == 2732639
    assert k["total_maintenance_cost"] == 29053208.8125
    b = date_bounds(t).first()
    assert (str(b["min_date"]), str(b["max_date"])) == ("2024-01-01", "2024-01-30")
    c = health_status_counts(machine_health(t)).first()
    assert (c["healthy"], c["watch"], c["at_risk"]) == (75, 71, 4)


def test_cross_result_sums(t):
    k = kpis(t).first()
    assert total(alerts_by_machine(t), "WARNING") == k["warning_events"]
    assert total(alerts_by_machine(t), "CRITICAL") == k["critical_events"]
    assert total(machine_performance(t), "number_of_readings") == k["total_readings"]
    assert total(status_distribution(t), "count") == k["total_readings"]
    assert total(maintenance_by_type(t), "downtime_minutes") == k["total_downtime"]
    assert total(downtime_by_factory(t), "downtime_minutes") == k["total_downtime"]


def test_health_bounds(t):
    h = machine_health(t)
    bad = h.filter(
        (F.col("health_score") < 0)
        | (F.col("health_score") > 100)
        | (F.col("warnings") + F.col("criticals") > F.col("readings"))
    )
    assert bad.count() == 0
    c = health_status_counts(h).first()
    assert c["healthy"] + c["watch"] + c["at_risk"] == h.count()
