"""Semantic edge cases on hand-written rows (FIXTURES.md, section 4)."""

from __future__ import annotations

import pytest

from plants import D, clean_tables, event, machine, reading

from plantlens.operators import (
    Filters,
    alerts_by_machine,
    daily_trend,
    date_bounds,
    downtime_by_factory,
    enrich_maintenance,
    enrich_sensors,
    health_distribution,
    health_status_counts,
    kpis,
    latest_readings,
    machine_health,
    machine_master,
    machine_performance,
    maintenance_by_type,
    maintenance_history,
    option_values,
    resolve_date_range,
    status_distribution,
    top_risk_machines,
)
from plantlens.operators.clean import clean_sensors
from plantlens.plans.checks import duplicate_machines
from plantlens.sources import csv


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


# --- cleaning --------------------------------------------------------------


def test_null_and_nan_measures_are_dropped(spark):  # T1
    t = clean_tables(
        spark,
        sensors=[reading("M1"), reading("M1", temp=None), reading("M1", temp=float("nan")),
                 reading("M1", energy=float("nan"))],
        machines=[machine("M1")],
    )
    assert t.sensors.count() == 1


def test_bad_timestamp_text_is_dropped_without_error(spark):  # T2
    t = clean_tables(
        spark,
        sensors=[reading("M1"), reading("M1", ts="yesterday"), reading("M1", ts=None)],
        machines=[machine("M1", install="not a date")],
        maintenance=[event("E1", "M1"), event("E2", "M1", day="2024-13-45")],
    )
    assert t.sensors.count() == 1
    assert t.machines.count() == 1  # install_date is optional
    assert t.machines.first()["install_date"] is None
    assert t.maintenance.count() == 1


def test_bad_number_cell_in_csv_drops_only_that_row(spark, tmp_path):  # T3
    path = tmp_path / "sensors.csv"
    path.write_text(
        "timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status\n"
        "2024-01-02 10:00:00,M1,70.5,5,2,10,OK\n"
        "2024-01-02 11:00:00,M1,hot,5,2,10,WARNING\n"
        "2024-01-02T12:00:00,M1,71.5,5,2,10,\n"
    )
    raw = csv.read_sensors(spark, str(path))
    assert dict(raw.dtypes)["temperature_c"] == "double"
    sensors = clean_sensors(raw)
    rows = sensors.orderBy("timestamp").collect()
    assert [r["temperature_c"] for r in rows] == [70.5, 71.5]
    assert rows[1]["status"] is None
    assert rows[0]["date"] == D(2024, 1, 2)


def test_machines_missing_required_columns_are_rejected(spark):  # T7
    t = clean_tables(
        spark,
        sensors=[reading("M1"), reading("M2")],
        machines=[machine("M1"), machine("M2", model=None)],
    )
    assert t.machines.count() == 1
    rows = {r["machine_id"]: r["factory"] for r in enrich_sensors(t).collect()}
    assert rows == {"M1": "F1", "M2": None}


# --- joins and filters ---------------------------------------------------------


def test_unknown_machine_kept_by_left_join_dropped_by_dimension_filter(spark):  # T6
    t = clean_tables(spark, sensors=[reading("M1"), reading("M9")], machines=[machine("M1")])
    assert enrich_sensors(t).count() == 2
    assert enrich_sensors(t, Filters(factory="F1")).count() == 1
    assert one(kpis(t))["total_readings"] == 2
    assert one(kpis(t, Filters(factory="F1")))["total_readings"] == 1
    health = {r["machine_id"]: r["factory"] for r in machine_health(t).collect()}
    assert health == {"M1": "F1", "M9": None}


def test_duplicate_machine_rows_repeat_facts(spark):  # T8
    t = clean_tables(
        spark,
        sensors=[reading("M1", status="WARNING")],
        machines=[machine("M1"), machine("M1")],
        maintenance=[event("E1", "M1", downtime=30, cost=10.0)],
    )
    assert enrich_sensors(t).count() == 2
    k = one(kpis(t))
    assert (k["total_machines"], k["total_readings"], k["warning_events"]) == (1, 2, 2)
    assert (k["total_downtime"], k["total_maintenance_cost"]) == (60, 20.0)
    h = one(machine_health(t))
    assert (h["readings"], h["warnings"]) == (2, 2)
    assert one(machine_performance(t))["number_of_readings"] == 2
    assert one(alerts_by_machine(t))["WARNING"] == 2
    assert [tuple(r) for r in duplicate_machines(t.machines).collect()] == [("M1", 2)]


def test_duplicate_machine_rows_with_different_attributes(spark):  # T8
    t = clean_tables(
        spark,
        sensors=[reading("M1")],
        machines=[machine("M1", factory="F1"), machine("M1", factory="F2")],
        maintenance=[event("E1", "M1", downtime=30)],
    )
    assert machine_health(t).count() == 2
    assert one(kpis(t, Filters(factory="F2")))["total_readings"] == 1
    by_factory = {r["factory"]: r["downtime_minutes"] for r in downtime_by_factory(t).collect()}
    assert by_factory == {"F1": 30, "F2": 30}


def test_machine_without_readings(spark):  # T9
    t = clean_tables(spark, sensors=[reading("M1")], machines=[machine("M1"), machine("M2")])
    assert one(kpis(t))["total_machines"] == 1
    assert [r["machine_id"] for r in machine_master(t).collect()] == ["M1", "M2"]


def test_status_filter_touches_sensors_only(spark):  # T10, T11
    t = clean_tables(
        spark,
        sensors=[reading("M1", status="OK"), reading("M1", status="CRITICAL")],
        machines=[machine("M1")],
        maintenance=[event("E1", "M1", downtime=45)],
    )
    f = Filters(status="CRITICAL")
    k = one(kpis(t, f))
    assert (k["total_readings"], k["critical_events"], k["total_downtime"]) == (1, 1, 45)
    assert one(machine_health(t, f))["readings"] == 2


def test_null_status_counts_but_never_alerts(spark):  # T5
    t = clean_tables(
        spark,
        sensors=[reading("M1", status=None), reading("M1", status="OK")],
        machines=[machine("M1")],
    )
    k = one(kpis(t))
    assert (k["total_readings"], k["warning_events"], k["critical_events"]) == (2, 0, 0)
    dist = {r["status"]: r["count"] for r in status_distribution(t).collect()}
    assert dist == {None: 1, "OK": 1}
    assert alerts_by_machine(t).count() == 0


def test_date_range_is_inclusive_and_needs_both_bounds(spark):  # F6, F8
    t = clean_tables(
        spark,
        sensors=[reading("M1", ts="2024-01-05 00:00:00"), reading("M1", ts="2024-01-12 23:59:59"),
                 reading("M1", ts="2024-01-13 00:00:00"), reading("M1", ts="2024-01-04 23:59:59")],
        machines=[machine("M1")],
        maintenance=[event("E1", "M1", day="2024-01-05"), event("E2", "M1", day="2024-01-13")],
    )
    both = Filters(start_date="2024-01-05", end_date="2024-01-12")
    assert enrich_sensors(t, both).count() == 2
    assert enrich_maintenance(t, both).count() == 1
    assert enrich_sensors(t, Filters(start_date="2024-01-05")).count() == 4
    assert enrich_sensors(t, Filters(end_date=D(2024, 1, 12))).count() == 4


def test_default_date_range_is_the_sensor_bounds(spark):  # F14
    t = clean_tables(
        spark,
        sensors=[reading("M1", ts="2024-01-03 08:00:00"), reading("M1", ts="2024-01-09 08:00:00")],
        machines=[machine("M1")],
        maintenance=[event("E1", "M1", day="2024-01-02"), event("E2", "M1", day="2024-01-03"),
                     event("E3", "M1", day="2024-01-09"), event("E4", "M1", day="2024-01-10")],
    )
    resolved = resolve_date_range(t, Filters(start_date=D(2024, 1, 3)))  # incomplete
    events = sorted(r["event_id"] for r in enrich_maintenance(t, resolved).collect())
    assert events == ["E2", "E3"]
    b = one(date_bounds(t))
    assert (b["min_date"], b["max_date"]) == (D(2024, 1, 3), D(2024, 1, 9))


def test_all_sentinel_means_no_filter(spark):  # T19
    t = clean_tables(spark, sensors=[reading("M1"), reading("M9")], machines=[machine("M1")])
    f = Filters(factory="All", production_line="All", model="All", machine_id="All", status="All")
    assert not f.has_dimension_filter
    assert enrich_sensors(t, f).count() == 2


# --- scores -----------------------------------------------------------------------


def test_score_is_rounded_before_classifying(spark):  # T13
    rows = [reading("M1", status="WARNING" if i < 201 else "OK") for i in range(2000)]
    t = clean_tables(spark, sensors=rows, machines=[machine("M1")])
    h = one(machine_health(t))
    assert (h["health_score"], h["health_status"], h["alert_rate_pct"]) == (90.0, "Healthy", 10.1)


def test_score_is_clamped_at_zero(spark):  # H4
    rows = [reading("M1", status="CRITICAL" if i < 4 else "OK") for i in range(10)]
    t = clean_tables(spark, sensors=rows, machines=[machine("M1")])
    h = one(machine_health(t))
    assert (h["health_score"], h["health_status"], h["alert_rate_pct"]) == (0.0, "At Risk", 40.0)


def test_kpi_alert_rate_is_unrounded_health_rate_is_rounded(spark):  # T12
    rows = [reading("M1", status="WARNING"), reading("M1"), reading("M1")]
    t = clean_tables(spark, sensors=rows, machines=[machine("M1")])
    assert one(kpis(t))["alert_rate"] == 1 / 3 * 100
    assert one(machine_health(t))["alert_rate_pct"] == 33.3
    assert one(machine_health(t))["health_status"] == "At Risk"  # 66.7 < 75


def test_health_views(spark):  # H7, H8, O8, T15
    ids = [f"M{i}" for i in range(1, 8)]
    rows = [reading(m) for m in ids] + [reading("M7", status="CRITICAL")] * 3
    t = clean_tables(spark, sensors=rows, machines=[machine(m) for m in ids])
    health = machine_health(t)
    c = one(health_status_counts(health))
    assert (c["healthy"], c["watch"], c["at_risk"]) == (6, 0, 1)
    dist = [tuple(r) for r in health_distribution(health).collect()]
    assert dist == [("Healthy", 6), ("At Risk", 1)]
    top = [r["machine_id"] for r in top_risk_machines(health).collect()]
    assert top == ["M7", "M1", "M2", "M3", "M4"]


# --- empty input --------------------------------------------------------------------


def test_empty_input(spark):  # T16
    t = clean_tables(spark)
    k = one(kpis(t))
    assert (k["total_machines"], k["total_readings"], k["warning_events"]) == (0, 0, 0)
    assert k["average_temperature"] is None and k["average_vibration"] is None
    assert (k["total_downtime"], k["total_maintenance_cost"], k["alert_rate"]) == (0, 0.0, 0.0)
    assert k["downtime_hours"] == 0.0
    for op in (daily_trend, machine_performance, alerts_by_machine, status_distribution,
               maintenance_by_type, downtime_by_factory, machine_health, latest_readings,
               maintenance_history):
        assert op(t).count() == 0, op.__name__
    b = one(date_bounds(t))
    assert b["min_date"] is None and b["max_date"] is None
    c = one(health_status_counts(machine_health(t)))
    assert (c["healthy"], c["watch"], c["at_risk"]) == (0, 0, 0)


# --- previews and options --------------------------------------------------------------


def test_latest_rows_break_ties_deterministically(spark):  # T15
    same = "2024-01-02 10:00:00"
    rows = [reading(f"M{i}", ts=same) for i in (3, 1, 2)] + [reading("M4", ts="2024-01-01 00:00:00")]
    t = clean_tables(spark, sensors=rows, machines=[machine(f"M{i}") for i in range(1, 5)],
                     maintenance=[event(f"E{i}", "M1") for i in (2, 3, 1)])
    assert [r["machine_id"] for r in latest_readings(t, n=3).collect()] == ["M1", "M2", "M3"]
    assert [r["event_id"] for r in maintenance_history(t, n=2).collect()] == ["E1", "E2"]
    # with a dimension filter the top-k runs after the join
    only = latest_readings(t, Filters(factory="F1"), n=2).collect()
    assert [r["machine_id"] for r in only] == ["M1", "M2"]


def test_dependent_options(spark):  # F13, D3-D6
    t = clean_tables(
        spark,
        machines=[machine("M1", "B", "L2", "X"), machine("M2", "A", "L1", "Y"),
                  machine("M3", "A", "L1", "X"), machine("M4", "A", "L3", "X")],
    )
    values = lambda col, f=Filters(): [r[0] for r in option_values(t, col, f).collect()]
    assert values("factory") == ["A", "B"]
    assert values("production_line", Filters(factory="A")) == ["L1", "L3"]
    assert values("model", Filters(factory="A", production_line="L1")) == ["X", "Y"]
    assert values("machine_id", Filters(factory="A", production_line="L1", model="X")) == ["M3"]


def test_load_csv_folder_and_prepare(spark, tmp_path):  # S4, J3
    from plantlens.operators import clean, prepare
    from plantlens.sources import load

    (tmp_path / "sensor_readings.csv").write_text(
        "timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status\n"
        "2024-01-02 10:00:00,M1,70,5,2,10,OK\n2024-01-02 11:00:00,M2,71,5,2,10,WARNING\n")
    (tmp_path / "machines.csv").write_text(
        "machine_id,factory,production_line,model,install_date,criticality,"
        "maintenance_interval_days\nM1,F1,L1,X1,2020-01-01,Low,30\n")
    (tmp_path / "maintenance_events.csv").write_text(
        "event_id,machine_id,event_date,maintenance_type,downtime_minutes,cost_eur,"
        "technician_id,issue\nE1,M1,2024-01-02,Preventive,30,12.5,T01,Routine inspection\n")
    sensors, events, machines = prepare(clean(load(spark, str(tmp_path))))
    assert sorted((r["machine_id"], r["factory"]) for r in sensors.collect()) == [
        ("M1", "F1"), ("M2", None)]
    assert events.first()["factory"] == "F1"
    assert machines.count() == 1


def test_status_options_are_fixed_values():  # D7
    from plantlens.operators import status_options

    assert status_options() == ("OK", "WARNING", "CRITICAL")


def test_without_readings_the_default_range_keeps_events(spark):  # F14
    t = clean_tables(spark, machines=[machine("M1")], maintenance=[event("E1", "M1", downtime=60)])
    k = one(kpis(t, resolve_date_range(t, Filters())))
    assert (k["total_downtime"], k["total_readings"]) == (60, 0)


def test_csv_columns_are_found_by_name(spark, tmp_path):  # S1-S3
    from plantlens.operators import clean
    from plantlens.operators.clean import rejects
    from plantlens.sources import load

    (tmp_path / "sensor_readings.csv").write_text(
        "note,status,energy_kwh,machine_id,pressure_bar,temperature_c,vibration_mm_s,timestamp\n"
        "x,OK,10,M1,5,70,2,2024-01-02 10:00:00\ny,OK,10,M1,five,70,2,2024-01-02 11:00:00\n")
    (tmp_path / "machines.csv").write_text(
        "factory,machine_id,model,production_line,criticality,maintenance_interval_days,install_date\n"
        "F1,M1,X1,L1,Low,30.0,2020-01-01\n")
    (tmp_path / "maintenance_events.csv").write_text(
        "event_id,machine_id,event_date,maintenance_type,downtime_minutes,cost_eur,technician_id,issue\n"
        "E1,M1,2024-01-02,Preventive,45.5,12.5,T01,a\nE2,M1,2024-01-02,Preventive,45.0,1,T01,b\n"
        "E3,M1,yesterday,Preventive,,1,T01,c\n")
    raw = load(spark, str(tmp_path))
    t = clean(raw)
    s = one(t.sensors)
    assert (s["machine_id"], s["temperature_c"], s["pressure_bar"], s["energy_kwh"]) == ("M1", 70.0, 5.0, 10.0)
    assert (one(t.machines)["factory"], one(t.machines)["maintenance_interval_days"]) == ("F1", 30)
    assert sorted(r["downtime_minutes"] for r in t.maintenance.collect()) == [45.0, 45.5]
    counts = {(r["table"], r["reason"]): r["rows"] for r in rejects(raw).collect() if r["rows"]}
    assert counts == {
        ("sensors", "pressure_bar"): 1, ("sensors", "any"): 1, ("maintenance", "event_date"): 1,
        ("maintenance", "downtime_minutes"): 1, ("maintenance", "any"): 1,
    }
    (tmp_path / "machines.csv").write_text("machine_id,factory\nM1,F1\n")
    with pytest.raises(ValueError, match="production_line"):
        load(spark, str(tmp_path))


def test_long_keys_are_not_cut(spark):
    from plantlens.sources.bind import machine_key

    keys = [1, 123456, 1000000, 1000001, 123456789, None]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k bigint").select(machine_key("k")).collect()]
    assert got == ["M000001", "M123456", "M1000000", "M1000001", "M123456789", None]


def test_reading_id_option_leaves_the_declared_schema_alone(spark, tmp_path):
    from plantlens.schemas import SENSOR_CSV

    before = len(SENSOR_CSV.fields)
    path = tmp_path / "s.csv"
    path.write_text("timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,"
                    "energy_kwh,status,reading_id\n2024-01-02 10:00:00,M1,70,5,2,10,OK,7\n")
    assert csv.read_sensors(spark, str(path)).first()["reading_id"] == 7
    assert len(SENSOR_CSV.fields) == before
