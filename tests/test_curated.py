"""Curated layer, rollup and refresh: same results as the direct path."""

from __future__ import annotations

import pytest
from compare import spark_rows
from plants import SF001, clean_tables, event, machine, reading

from plantlens.operators import (
    Filters,
    latest_readings,
    maintenance_history,
    alerts_by_machine,
    daily_trend,
    date_bounds,
    downtime_by_factory,
    kpis,
    machine_health,
    machine_performance,
    maintenance_by_type,
    status_distribution,
)
from plantlens.plans.curated import write_curated
from plantlens.plans.refresh import refresh
from plantlens.registry import tables
from plantlens.session import fresh_dir
from plantlens.sources import parquet

AGGREGATES = (kpis, machine_health, daily_trend, machine_performance, alerts_by_machine,
              status_distribution, maintenance_by_type, downtime_by_factory, date_bounds)
FILTER_SETS = (
    Filters(),
    Filters(factory="ASIA", start_date="2024-01-05", end_date="2024-01-12"),
    Filters(status="WARNING", machine_id="M000002"),
    Filters(production_line="NATION_2", model="MACHINERY"),
)


@pytest.fixture(scope="module")
def direct(spark):
    return tables(spark, SF001)


@pytest.fixture(scope="module")
def curated(spark, direct):
    return write_curated(spark, direct, fresh_dir(spark, "test-curated"))


@pytest.mark.parametrize("op", AGGREGATES, ids=lambda op: op.__name__)
@pytest.mark.parametrize("f", FILTER_SETS, ids=range(len(FILTER_SETS)))
def test_rollup_path_equals_direct_path(direct, curated, op, f):
    assert spark_rows(op(curated, f)) == spark_rows(op(direct, f))


@pytest.mark.parametrize("op", (latest_readings, maintenance_history), ids=lambda op: op.__name__)
@pytest.mark.parametrize("f", FILTER_SETS, ids=range(len(FILTER_SETS)))
@pytest.mark.parametrize("n", (1, 7, 500, 100000))
def test_previews_read_recent_days_only_and_stay_exact(direct, curated, op, f, n):
    assert spark_rows(op(curated, f, n=n)) == spark_rows(op(direct, f, n=n))


def test_preview_scan_is_pruned_by_the_rollup(curated):
    from test_plans import plan

    text = plan(latest_readings(curated))
    scan = text.split("PartitionFilters:")[1].split("\n")[0]
    assert "date" in scan and "subquery" in scan.lower()


def test_rollup_path_on_duplicates_and_unknown_machines(spark):
    t = clean_tables(
        spark,
        sensors=[reading("M1", status="WARNING"), reading("M1"), reading("M9", status=None),
                 reading("M2", ts="2024-01-03 01:00:00", status="CRITICAL")],
        machines=[machine("M1"), machine("M1"), machine("M2", factory="F2")],
        maintenance=[event("E1", "M1"), event("E2", "M9")],
    )
    c = write_curated(spark, t, fresh_dir(spark, "test-curated-edge"))
    for f in (Filters(), Filters(factory="F1"), Filters(status="OK")):
        for op in AGGREGATES + (latest_readings, maintenance_history):
            assert spark_rows(op(c, f)) == spark_rows(op(t, f)), op.__name__


def test_refresh_writes_every_result(spark, curated):
    out = fresh_dir(spark, "test-refresh")
    rows = {r["result"]: r["rows"] for r in refresh(spark, curated, Filters(), out).collect()}
    assert rows["kpis"] == 1 and rows["date_bounds"] == 1
    assert rows["machine_health"] == 15
    assert rows["top_risk_machines"] == 5
    assert rows["latest_readings"] == 500
    assert rows["daily_trend"] == 30
    assert len(rows) == 19


def test_empty_tables_through_the_curated_layer(spark):
    """A partitioned write of an empty table leaves no file to infer a
    schema from; the layer still reads back and the results are empty."""
    t = clean_tables(spark, machines=[machine("M1")])
    root = fresh_dir(spark, "test-curated-empty")
    c = write_curated(spark, t, root)
    k = kpis(c).first()
    assert (k["total_readings"], k["total_downtime"], k["alert_rate"]) == (0, 0, 0.0)
    assert machine_health(c).count() == 0 and latest_readings(c).count() == 0
    again = parquet.read_tables(spark, root, with_aggregates=True)  # as a later session does
    assert again.maintenance.schema == c.maintenance.schema and machine_health(again).count() == 0
    rows = {r["result"]: r["rows"] for r in refresh(spark, again, Filters(),
                                                    fresh_dir(spark, "test-refresh-empty")).collect()}
    assert rows["machine_master"] == 1 and rows["daily_trend"] == 0


def test_readers_see_the_last_finished_version(spark, monkeypatch):
    root = fresh_dir(spark, "test-versions")
    write_curated(spark, clean_tables(spark, machines=[machine("M1")]), root)
    two = clean_tables(spark, machines=[machine("M1"), machine("M2")])
    with monkeypatch.context() as m:
        def broken(*_):
            raise OSError("disk full")

        m.setattr("plantlens.plans.curated.write_aggregates", broken)
        with pytest.raises(OSError):
            write_curated(spark, two, root)
    assert parquet.read_tables(spark, root).machines.count() == 1
    write_curated(spark, two, root)
    assert parquet.read_tables(spark, root, with_aggregates=True).machine_copies.count() == 2


def test_another_time_zone_is_refused(spark):
    root = fresh_dir(spark, "test-zone")
    write_curated(spark, clean_tables(spark, machines=[machine("M1")]), root)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        with pytest.raises(ValueError, match="time zone"):
            parquet.read_tables(spark, root)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
