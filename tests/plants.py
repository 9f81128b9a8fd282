"""Small hand-made plant tables for the tests.

A module of its own, not part of conftest: every test folder has a module
called conftest, and only one of them can be imported by that name.
"""

from __future__ import annotations

import datetime as dt

from plantlens.operators.clean import clean
from plantlens.schemas import MACHINE_CSV, MAINTENANCE_CSV, SENSOR_CSV
from plantlens.tables import Tables

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def raw_tables(spark, sensors=(), machines=(), maintenance=()) -> Tables:
    """Raw text-typed tables from Python rows (CSV schemas)."""
    return Tables(
        sensors=spark.createDataFrame(list(sensors), SENSOR_CSV),
        machines=spark.createDataFrame(list(machines), MACHINE_CSV),
        maintenance=spark.createDataFrame(list(maintenance), MAINTENANCE_CSV),
    )


def clean_tables(spark, sensors=(), machines=(), maintenance=()) -> Tables:
    return clean(raw_tables(spark, sensors, machines, maintenance))


def reading(machine, ts="2024-01-02 10:00:00", temp=70.0, pressure=5.0, vib=2.0,
            energy=10.0, status="OK"):
    return (ts, machine, temp, pressure, vib, energy, status)


def machine(mid, factory="F1", line="L1", model="X1", install="2020-01-01",
            criticality="Low", interval=30):
    return (mid, factory, line, model, install, criticality, interval)


def event(eid, mid, day="2024-01-02", kind="Preventive", downtime=60, cost=100.0,
          tech="T01", issue="Routine inspection"):
    minutes = None if downtime is None else float(downtime)
    return (eid, mid, day, kind, minutes, cost, tech, issue)


D = dt.date
