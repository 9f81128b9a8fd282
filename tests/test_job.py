"""The command-line jobs: curate a CSV folder, refresh from the curated layer."""

from __future__ import annotations

import pytest

from plantlens.operators import machine_health
from plantlens.plans.job import main
from plantlens.plans.refresh import published
from plantlens.session import fresh_dir
from plantlens.sources import parquet


def write_csv_folder(folder):
    (folder / "sensor_readings.csv").write_text(
        "timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status\n"
        "2024-01-02 10:00:00,M1,70,5,2,10,OK\n"
        "2024-01-03 11:00:00,M1,71,5,2,10,CRITICAL\n"
        "2024-01-03 12:00:00,M2,72,5,2,10,WARNING\n")
    (folder / "machines.csv").write_text(
        "machine_id,factory,production_line,model,install_date,criticality,"
        "maintenance_interval_days\nM1,F1,L1,X1,2020-01-01,Low,30\nM2,F2,L2,X2,,High,60\n")
    (folder / "maintenance_events.csv").write_text(
        "event_id,machine_id,event_date,maintenance_type,downtime_minutes,cost_eur,"
        "technician_id,issue\nE1,M1,2024-01-02,Preventive,30,12.5,T01,Routine inspection\n")


def test_curate_then_refresh(spark, tmp_path):
    write_csv_folder(tmp_path)
    curated = fresh_dir(spark, "test-job-curated")
    out = fresh_dir(spark, "test-job-out")
    main(["curate", "--source", str(tmp_path), "--format", "csv", "--out", curated])
    main(["refresh", "--source", curated, "--curated", "--out", out, "--factory", "F1",
          "--start", "2024-01-01", "--end", "2024-01-31"])
    view = published(spark, out)
    kpi = view.result("kpis").first()
    assert (kpi["total_readings"], kpi["critical_events"], kpi["total_downtime"]) == (2, 1, 30)
    health = view.result("machine_health").collect()
    assert [(r["machine_id"], r["health_score"]) for r in health] == [("M1", 0.0)]

    # A corrected file replaces its days; a load that rejects too much is refused.
    (tmp_path / "sensor_readings.csv").write_text(
        "timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status\n"
        "2024-01-03 11:00:00,M1,71,5,2,10,OK\n")
    main(["correct", "--source", str(tmp_path), "--format", "csv", "--out", curated, "--days", "2024-01-03"])
    assert [r["readings"] for r in machine_health(parquet.read_tables(spark, curated, True)).collect()] == [2]
    (tmp_path / "sensor_readings.csv").write_text(
        "timestamp,machine_id,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status\nnever,M1,1,1,1,1,OK\n")
    with pytest.raises(SystemExit, match="100.0% of sensors"):
        main(["curate", "--source", str(tmp_path), "--format", "csv", "--out", curated, "--max-rejected", "0.1"])
    assert parquet.read_tables(spark, curated).sensors.count() == 2
