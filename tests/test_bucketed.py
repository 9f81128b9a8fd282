"""Bucketed versions: same rows, one bucket for one machine, joins without
an exchange, hot machines joined apart."""

from __future__ import annotations

import glob

import pytest
from compare import spark_rows
from plants import SF001, clean_tables, event, machine, reading

from plantlens.operators import Filters, enrich_maintenance, enrich_sensors, kpis, latest_readings, machine_health
from plantlens.plans import bucketed as B
from plantlens.plans.curated import write_curated
from plantlens.registry import tables
from plantlens.session import fresh_dir
from plantlens.sources import parquet

ENRICH = (enrich_sensors, enrich_maintenance)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def direct(spark):
    return tables(spark, SF001)


@pytest.fixture(scope="module")
def root(spark):
    return fresh_dir(spark, "test-bucketed")


@pytest.fixture(scope="module")
def own(spark, direct, root):
    return B.write_bucketed(spark, direct, root, buckets=8)


@pytest.fixture
def no_broadcast(spark):
    """The machines are too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("f", [Filters(), Filters(factory="ASIA", start_date="2024-01-05", end_date="2024-01-12"),
                               Filters(machine_id="M000002")], ids=str)
@pytest.mark.parametrize("op", [*ENRICH, kpis, machine_health, latest_readings], ids=lambda op: op.__name__)
def test_results_are_the_same(direct, own, op, f):
    assert spark_rows(op(own, f)) == spark_rows(op(direct, f))


@pytest.mark.parametrize("op", ENRICH, ids=lambda op: op.__name__)
def test_joins_need_no_exchange(direct, own, no_broadcast, op):
    plan = physical(op(own))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in physical(op(direct))


def rows_read(df) -> int:
    """Rows that the file scans of a plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_machine_is_one_bucket(spark, own, root, direct):
    """The scan for one machine puts out rows of its bucket only; one of
    unbucketed files puts out rows of other machines too."""
    in_bucket = own.sensors.where(B.bucket(8) == own.sensors.select(B.bucket(8)).where("machine_id = 'M000002'").first()[0])
    own_rows = rows_read(own.sensors.where("machine_id = 'M000002'"))
    assert 0 < own_rows <= in_bucket.count() < direct.sensors.count() / 2
    loose = fresh_dir(spark, "test-loose")
    direct.sensors.coalesce(1).write.partitionBy("date").parquet(loose)
    assert own_rows < rows_read(spark.read.parquet(loose).where("machine_id = 'M000002'")) / 2


def test_a_later_session_finds_the_buckets(spark, own, root, no_broadcast, direct):
    version = parquet.checked_version(spark, root).name
    for table in B.TABLES:
        spark.sql(f"DROP TABLE {B.catalog_name(version, table)}")  # the files stay
    again = B.read_bucketed(spark, root)
    assert "Exchange" not in physical(enrich_sensors(again))
    assert spark_rows(enrich_sensors(again)) == spark_rows(enrich_sensors(direct))
    # The same folder as an ordinary version.
    assert spark_rows(enrich_sensors(parquet.read_tables(spark, root))) == spark_rows(enrich_sensors(direct))


@pytest.fixture(scope="module")
def skewed(spark):
    """One machine has two thirds of the readings and two dimension rows."""
    return clean_tables(
        spark,
        sensors=[reading("HOT", ts=f"2024-01-{1 + i % 3:02d} 10:00:00", temp=float(i)) for i in range(400)]
        + [reading(f"M{i}", ts=f"2024-01-{1 + i % 3:02d} 11:00:00") for i in range(200)],
        machines=[machine("HOT"), machine("HOT", factory="F2")] + [machine(f"M{i}") for i in range(0, 200, 2)],
        maintenance=[event(f"E{i}", f"M{i}") for i in range(50)],
    )


def test_hot_machines_are_joined_apart(spark, skewed, no_broadcast):
    own = B.write_bucketed(spark, skewed, fresh_dir(spark, "test-hot"), buckets=16)
    assert own.hot == ("HOT",) and own.hot_is_small
    joined = enrich_sensors(own)
    plan = physical(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert "hashpartitioning" not in plan  # nothing is shuffled for it
    for f in (Filters(), Filters(factory="F2"), Filters(machine_id="HOT"), Filters(machine_id="M7")):
        assert spark_rows(enrich_sensors(own, f)) == spark_rows(enrich_sensors(skewed, f))
        assert spark_rows(enrich_maintenance(own, f)) == spark_rows(enrich_maintenance(skewed, f))


def test_many_rows_of_hot_machines_are_not_broadcast(spark, skewed, monkeypatch, no_broadcast):
    monkeypatch.setattr(B, "HOT_ROWS", 1)
    own = B.write_bucketed(spark, skewed, fresh_dir(spark, "test-hot"), buckets=16)
    assert own.hot == ("HOT",) and not own.hot_is_small
    assert "BroadcastHashJoin" not in physical(enrich_sensors(own))
    assert spark_rows(enrich_sensors(own)) == spark_rows(enrich_sensors(skewed))


def test_empty_tables(spark):
    own = B.write_bucketed(spark, clean_tables(spark, machines=[machine("M1")]), fresh_dir(spark, "test-bucketed"), 4)
    assert enrich_sensors(own).count() == 0 and machine_health(own).count() == 0 and own.hot == ()


def test_a_day_bucket_is_one_file(spark, own, root):
    version = parquet.checked_version(spark, root).name
    day = glob.glob(f"{root}/{version}/sensors/date=2024-01-05/*.parquet")
    assert 1 < len(day) <= 8


def test_without_buckets_there_is_nothing_to_attach(spark, direct):
    plain = fresh_dir(spark, "test-plain")
    write_curated(spark, clean_tables(spark, machines=[machine("M1")]), plain)
    with pytest.raises(LookupError):
        B.read_bucketed(spark, plain)
