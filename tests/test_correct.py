"""Corrections by day equal a full rebuild and write the day only."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from compare import spark_rows
from plants import SF001, clean_tables, event, machine, reading
from pyspark.sql import functions as F

from plantlens.operators import Filters, daily_trend, downtime_by_factory, kpis, latest_readings, machine_health
from plantlens.plans import correct as C
from plantlens.plans.curated import write_curated
from plantlens.registry import tables
from plantlens.session import fresh_dir
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Version

DAY = "2024-01-10"
OPS = (kpis, machine_health, daily_trend, downtime_by_factory, latest_readings)


def spoiled(t):
    """The tables with one day wrong: readings without their alerts and
    twice, events without cost."""
    wrong = F.col("date") == DAY
    bad = t.sensors.where(wrong).withColumn("status", F.lit("OK"))
    costs = F.when(F.col("event_date") == DAY, F.lit(0.0)).otherwise(F.col("cost_eur"))
    return replace(
        t,
        sensors=t.sensors.where(~wrong).unionByName(bad).unionByName(bad),
        maintenance=t.maintenance.withColumn("cost_eur", costs),
    )


def folders(root, version, table):
    return sorted(d for d in os.listdir(os.path.join(root, version, table)) if "=" in d)


def test_a_corrected_day_equals_a_rebuild(spark):
    right = tables(spark, SF001)
    root = fresh_dir(spark, "test-correct")
    write_curated(spark, spoiled(right), root)
    first = versions.current(spark, root)
    wrong = parquet.read_tables(spark, root, with_aggregates=True)
    assert spark_rows(kpis(wrong)) != spark_rows(kpis(right))
    day = replace(right, sensors=right.sensors.where(F.col("date") == DAY),
                  maintenance=right.maintenance.where(F.col("event_date") == DAY))
    fixed = C.corrected(spark, root, day)
    for op in OPS:
        for f in (Filters(), Filters(start_date=DAY, end_date="2024-01-12"), Filters(factory="ASIA")):
            assert spark_rows(op(fixed, f)) == spark_rows(op(right, f)), op.__name__
    # Only the day was written, and it alone is read for the day.
    now = versions.current(spark, root)
    assert now.parent == first.name and now.facts["corrected"] == {"sensors": [DAY], "maintenance": [DAY]}
    for table, column in parquet.DAYS.items():
        assert folders(root, now.name, table) == [f"{column}={DAY}"]
    assert not os.path.exists(os.path.join(root, now.name, "machines"))
    one_day = parquet.read_tables(spark, root).sensors.where(F.col("date") == DAY)
    assert {p.split("/date=")[0].rsplit("/", 2)[1] for p in one_day.inputFiles()} >= {now.name}
    read = {r[0].split("/date=")[0].rsplit("/", 2)[1] for r in one_day.select(F.input_file_name()).distinct().collect()}
    assert read == {now.name}
    # Who holds the version before still reads it.
    before = parquet.read_tables(spark, root, with_aggregates=True, version=first.name)
    assert spark_rows(kpis(before)) == spark_rows(kpis(wrong))


@pytest.fixture
def plant(spark):
    t = clean_tables(
        spark,
        sensors=[reading("M1", ts=f"2024-01-{d:02d} 10:00:00", temp=float(d)) for d in range(1, 5)],
        machines=[machine("M1")],
        maintenance=[event(f"E{d}", "M1", day=f"2024-01-{d:02d}") for d in range(1, 4)],
    )
    root = fresh_dir(spark, "test-correct")
    write_curated(spark, t, root)
    return root


def only(spark, **days):
    return clean_tables(
        spark, sensors=[reading("M1", ts=f"{d} 11:00:00", temp=t) for d, t in days.get("sensors", [])]
    ).sensors


def temperatures(spark, root):
    rows = parquet.read_tables(spark, root).sensors.collect()
    daily = daily_trend(parquet.read_tables(spark, root, with_aggregates=True)).collect()
    assert len(daily) == len({r.date for r in rows})
    return sorted((str(r.date), r.temperature_c) for r in rows)


def test_corrections_of_corrections(spark, plant):
    C.replace_days(spark, plant, only(spark, sensors=[("2024-01-02", 20.0), ("2024-01-03", 30.0)]))
    C.replace_days(spark, plant, only(spark, sensors=[("2024-01-03", 33.0), ("2024-01-03", 34.0)]))
    C.replace_days(spark, plant, only(spark, sensors=[("2024-01-09", 9.0)]))  # a day that is new
    assert temperatures(spark, plant) == [
        ("2024-01-01", 1.0), ("2024-01-02", 20.0), ("2024-01-03", 33.0), ("2024-01-03", 34.0), ("2024-01-04", 4.0),
        ("2024-01-09", 9.0),
    ]
    C.replace_days(spark, plant, only(spark), days=["2024-01-03", "2024-01-09"])  # days that are gone
    assert [d for d, _ in temperatures(spark, plant)] == ["2024-01-01", "2024-01-02", "2024-01-04"]
    k = kpis(parquet.read_tables(spark, plant, with_aggregates=True)).first()
    assert (k.total_readings, k.total_downtime) == (3, 180)  # events were not touched
    whole = parquet.read_tables(spark, plant)
    write_curated(spark, whole, plant)  # one folder again
    assert versions.current(spark, plant).parts == {}
    assert [d for d, _ in temperatures(spark, plant)] == ["2024-01-01", "2024-01-02", "2024-01-04"]


def test_rows_of_other_days_are_left_out(spark, plant):
    C.replace_days(spark, plant, only(spark, sensors=[("2024-01-01", 10.0), ("2024-01-02", 20.0)]), days=["2024-01-02"])
    assert temperatures(spark, plant)[:2] == [("2024-01-01", 1.0), ("2024-01-02", 20.0)]


def test_nothing_to_correct(spark, plant):
    before = versions.current(spark, plant)
    assert C.replace_days(spark, plant, only(spark)) == before == versions.current(spark, plant)
    with pytest.raises(LookupError):
        C.replace_days(spark, fresh_dir(spark, "test-nothing"), only(spark))
    with pytest.raises(ValueError):
        C.replace_days(spark, plant, only(spark), days=["soon"])


def test_a_correction_that_was_overtaken_is_refused(spark, plant, monkeypatch):
    new = only(spark, sensors=[("2024-01-02", 20.0)])
    rollup = C.ROLLUPS["sensors"]

    def late(rows):
        versions.commit(spark, plant, Version(versions.begin(), "UTC", parts=versions.current(spark, plant).parts))
        return rollup[1](rows)

    current = versions.current(spark, plant).name
    monkeypatch.setitem(C.ROLLUPS, "sensors", (rollup[0], late))
    with pytest.raises(C.Superseded, match=current):
        C.replace_days(spark, plant, new)
