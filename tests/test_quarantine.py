"""Loading with quarantine: the accepted rows of the clean step, every other
row with its defects, from one scan."""

from __future__ import annotations

import glob
import os
import random

import pytest
from plants import SF001

from plantlens.operators import clean, kpis, machine_health
from plantlens.operators import quarantine as Q
from plantlens.plans import load as L
from plantlens.session import fresh_dir
from plantlens.sources import csv, load, load_cells, parquet, versions
from plantlens.sources.bind import bind

SENSORS = """machine_id,timestamp,temperature_c,pressure_bar,vibration_mm_s,energy_kwh,status,extra
M1,2024-01-02 10:00:00,70,5,2,10,OK,x
M1,2024-13-02 10:00:00,7o,5,2,10,OK,x
M2,2024-01-03 10:00:00,NaN,,2,10,,x
M2,2024-01-03 10:00:00,1,1
M3,2024-01-03 11:00:00,1,1,1,1,OK,x,y,z
"""
MACHINES = """machine_id,factory,production_line,model,install_date,criticality,maintenance_interval_days
M1,F1,L1,X1,soon,Low,often
M2,F2,L2,,,High,60
"""
EVENTS = """event_id,machine_id,event_date,maintenance_type,downtime_minutes,cost_eur,technician_id,issue
E1,M1,2024-01-02,Preventive,30,12.5,T01,Routine
E2,M1,nope,Preventive,x,12.5,T01,Routine
"""


def folder(tmp_path, sensors=SENSORS, machines=MACHINES, events=EVENTS):
    for name, text in zip(("sensor_readings.csv", "machines.csv", "maintenance_events.csv"), (sensors, machines, events)):
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def defects(df):
    return sorted([(d["column"], d["problem"], d["value"]) for d in r["defects"]] for r in df.collect())


def same_rows(a, b):
    columns = sorted(b.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_each_rejected_row_says_why(spark, tmp_path):
    source, root = folder(tmp_path), fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, load_cells(spark, source), root)
    assert defects(L.quarantine(spark, root, "sensors")) == sorted([
        [("timestamp", "unreadable", "2024-13-02 10:00:00"), ("temperature_c", "unreadable", "7o")],
        [("temperature_c", "not a number", "NaN"), ("pressure_bar", "missing", None)],
        [("vibration_mm_s", "missing", None), ("energy_kwh", "missing", None),
         ("row", "cells", "M2,2024-01-03 10:00:00,1,1")],
    ])
    assert defects(L.quarantine(spark, root, "machines")) == [[("model", "missing", None)]]
    assert defects(L.quarantine(spark, root, "maintenance")) == [
        [("event_date", "unreadable", "nope"), ("downtime_minutes", "unreadable", "x")]
    ]
    counts = {(r["table"], r["reason"]): r["rows"] for r in L.load_counts(spark, root).collect()}
    assert (counts["sensors", "rows"], counts["sensors", "accepted"], counts["sensors", "row: cells"]) == (5, 2, 2)
    # Unreadable values of optional columns are counted, their rows stay.
    assert counts["machines", "install_date: unreadable"] == counts["machines", "maintenance_interval_days: unreadable"] == 1
    assert loaded.counts["machines"]["accepted"] == 1
    assert counts["sensors", "machine_id: missing"] == 0


def test_accepted_rows_are_the_clean_rows(spark, tmp_path):
    """Random cells: the accepted rows are those of the clean step."""
    rng = random.Random(11)
    cells = ["", "1", "-2.5", "NaN", "1e3", "x", "2024-01-05", "2024-01-05 10:11:12", "2024-02-30", " 7 ", "45.0", "M1", "Infinity"]

    def made(head, rows):
        return head + "\n" + "".join(",".join(rng.choices(cells, k=len(head.split(",")))) + "\n" for _ in range(rows))

    heads = [text.split("\n")[0] for text in (SENSORS, MACHINES, EVENTS)]
    source = folder(tmp_path, *(made(h, 400) for h in heads))
    for k, head in enumerate(heads):  # some rows of good cells, for every table
        good = {0: "M1,2024-01-02 10:00:00,70,5,2,10,OK,x\n", 1: "M1,F1,L1,X1,2020-01-01,Low,30\n",
                2: "E1,M1,2024-01-02,Preventive,30,12.5,T01,Routine\n"}[k]
        name = ("sensor_readings.csv", "machines.csv", "maintenance_events.csv")[k]
        with open(os.path.join(source, name), "a") as f:
            f.write(good * 3)
    root = fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, load_cells(spark, source), root)
    want = clean(load(spark, source))
    for table in L.TABLES:
        assert same_rows(getattr(loaded.tables, table), getattr(want, table)), table
        rejected = L.quarantine(spark, root, table).count()
        assert rejected == loaded.counts[table]["rows"] - getattr(want, table).count() > 0
    again = parquet.read_tables(spark, root, with_aggregates=True)
    for op in (kpis, machine_health):
        assert same_rows(op(again), op(want))


def test_typed_sources_are_judged_too(spark):
    raw, root = bind(spark, SF001), fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, raw, root)
    want = clean(raw)
    for table in L.TABLES:
        assert same_rows(getattr(loaded.tables, table), getattr(want, table)), table
    kinds = {d["problem"] for r in L.quarantine(spark, root, "sensors").collect() for d in r["defects"]}
    assert kinds == {"missing", "not a number"}


def test_one_scan_gives_rows_verdicts_and_counts(spark, tmp_path):
    raw = load_cells(spark, folder(tmp_path)).sensors
    marked = Q.marked(raw, "sensors")
    rows = Q.parsed(marked.observe("counts", *Q.measures(marked, "sensors")), "sensors")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "CollectMetrics" in plan
    assert "Exchange" not in plan and "Join" not in plan


def test_observed_counts_equal_recounted_ones(spark, tmp_path):
    raw = load_cells(spark, folder(tmp_path))
    root = fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, raw, root)
    for table, counts in loaded.counts.items():
        rows = parquet.read_path(spark, L.judged_path(root, loaded.version, table))
        names = list(dict.fromkeys(c.split(": ")[0] for c in counts if ": " in c))
        assert Q.recounted(rows, table, names).first().asDict() == counts


def test_a_load_above_the_limit_is_not_published(spark, tmp_path):
    root = fresh_dir(spark, "test-load")
    first = L.load_curated(spark, load_cells(spark, folder(tmp_path)), root, max_rejected=0.7)
    worse = SENSORS + "M9,never,1,1,1,1,OK,x\n" * 20
    with pytest.raises(L.TooManyRejected) as refused:
        L.load_curated(spark, load_cells(spark, folder(tmp_path, sensors=worse)), root, max_rejected=0.7)
    assert set(refused.value.shares) == {"sensors"} and refused.value.shares["sensors"] == pytest.approx(23 / 25)
    assert versions.current(spark, root).name == first.version
    assert parquet.read_tables(spark, root).sensors.count() == 2
    # What was refused can be looked at by its name.
    assert L.quarantine(spark, root, "sensors", refused.value.version).count() == 23


def test_nothing_accepted_and_nothing_at_all(spark, tmp_path):
    heads = [text.split("\n")[0] + "\n" for text in (SENSORS, MACHINES, EVENTS)]
    root = fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, load_cells(spark, folder(tmp_path, *heads)), root, max_rejected=0.0)
    assert loaded.counts["sensors"]["rows"] == 0 and L.quarantine(spark, root, "sensors").count() == 0
    bad = [head + ",".join(["?"] * head.count(",")) + ",?\n" for head in heads]
    bad[1] = heads[1] + ",,,,,,\n"
    loaded = L.load_curated(spark, load_cells(spark, folder(tmp_path, *bad)), root)
    assert loaded.tables.sensors.count() == loaded.tables.machines.count() == 0
    assert machine_health(loaded.tables).count() == 0 and L.quarantine(spark, root, "sensors").count() == 1


def test_a_header_without_a_column_is_refused(spark, tmp_path):
    source = folder(tmp_path, machines=MACHINES.replace("factory", "plant"))
    with pytest.raises(ValueError, match="factory"):
        load_cells(spark, source)


def test_days_of_a_load_are_folders(spark, tmp_path):
    root = fresh_dir(spark, "test-load")
    loaded = L.load_curated(spark, load_cells(spark, folder(tmp_path)), root)
    path = L.judged_path(root, loaded.version, "sensors")
    assert glob.glob(f"{path}/accepted=true/date=2024-01-02/*.parquet")
    scan = loaded.tables.sensors.where("date = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in scan and "date" in scan.split("PartitionFilters")[1]


def test_cells_are_found_by_name(spark, tmp_path):
    path = tmp_path / "shuffled.csv"
    path.write_text("status,energy_kwh,machine_id,timestamp,vibration_mm_s,pressure_bar,temperature_c\nOK,4,M1,2024-01-02,3,2,1\n")
    row = Q.judged(csv.read_cells(spark, str(path), csv.SENSOR_COLUMNS, ("reading_id",)), "sensors").first()
    assert (row.temperature_c, row.pressure_bar, row.vibration_mm_s, row.energy_kwh) == (1, 2, 3, 4) and row.accepted
