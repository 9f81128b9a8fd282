"""Plan shape: pushdown, pruning, aggregate-before-join, top-k, no slow paths."""

from __future__ import annotations

import contextlib
import io

import pytest
from plants import SF001

from plantlens.operators import (
    Filters,
    date_bounds,
    enrich_sensors,
    kpis,
    latest_readings,
    machine_health,
    maintenance_history,
)
from plantlens.operators.clean import clean
from plantlens.plans.curated import write_curated
from plantlens.registry import ENTRIES, tables
from plantlens.session import fresh_dir
from plantlens.sources import parquet


def plan(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, SF001)


@pytest.fixture(scope="module")
def curated(spark, t):
    return write_curated(spark, t, fresh_dir(spark, "test-plans"))


def test_clean_pushes_not_null_checks_to_parquet(spark, curated):
    root = fresh_dir(spark, "test-raw")
    curated.sensors.drop("date").write.parquet(parquet.table_path(root, "sensors"))
    curated.machines.write.parquet(parquet.table_path(root, "machines"))
    curated.maintenance.write.parquet(parquet.table_path(root, "maintenance"))
    raw = parquet.read_tables(spark, root)
    text = plan(clean(raw).sensors)
    for col in ("machine_id", "temperature_c", "energy_kwh"):
        assert f"IsNotNull({col})" in text


def test_aggregation_runs_below_the_dimension_join(t):
    text = plan(machine_health(t), mode="simple")
    lines = text.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate" in line for line in lines[join_at + 1:])


def test_dimension_filter_turns_left_join_into_inner(t):
    assert "LeftOuter" in plan(enrich_sensors(t), mode="simple")
    text = plan(enrich_sensors(t, Filters(factory="ASIA")), mode="simple")
    assert "LeftOuter" not in text and "Inner" in text


def test_date_bounds_without_dimension_filter_skips_the_join(t):
    assert "Join" not in plan(date_bounds(t), mode="simple")


def test_latest_rows_are_top_k(t):
    assert plan(latest_readings(t)).count("TakeOrderedAndProject") >= 2
    assert "TakeOrderedAndProject" in plan(maintenance_history(t))


def test_date_filter_prunes_curated_partitions(curated):
    text = plan(enrich_sensors(curated, Filters(start_date="2024-01-05", end_date="2024-01-12")))
    assert "PartitionFilters: [isnotnull(date" in text
    assert "2024-01-05" in text.split("PartitionFilters:")[1].split("\n")[0]


def test_aggregate_layer_feeds_the_aggregates(curated):
    text = plan(kpis(curated))
    assert "sensor_rollup" in text and "event_rollup" in text and "machine_repeats" in text
    for row_level in ("/sensors]", "/maintenance]", "/machines]"):
        assert row_level not in text


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_no_python_udf_cross_join_or_driver_loop(spark, name):
    if name.startswith(("scan_", "published_")) or name in ("refresh_manifest", "reject_counts"):
        pytest.skip("writes files; covered by the oracle test")
    text = plan(ENTRIES[name].run(spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "LocalTableScan [", "Generate"):
        assert bad not in text, f"{name}: {bad}"
