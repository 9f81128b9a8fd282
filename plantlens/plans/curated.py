"""Curated layer: the clean tables written once as Parquet, plus the
aggregate layer.

Cleaning is done once per load instead of once per query, and later
queries read columnar files with pushed-down filters. ``sensors`` is
partitioned by ``date`` and ``maintenance`` by ``event_date``, so a date
range prunes whole folders (``PartitionFilters`` in the scan).

The aggregate layer (``write_aggregates``) holds what every aggregate
result is a re-aggregation of:

* ``sensor_rollup``: readings at (machine_id, date, status), counts and
  sums only -- feeds the KPIs, every sensor chart and the health table.
  Its size grows with machines x days, not with the reading rate.
* ``event_rollup``: maintenance events at (machine_id, event_date,
  maintenance_type) -- feeds the maintenance totals and charts.
* ``machine_copies``: the dimension with identical rows collapsed and
  counted, so a machine id repeated many times is one row.

Writing to the shared folder also cuts the lineage: the queries that
follow plan over files, not over the source and cleaning steps.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plantlens.operators.measures import (
    EVENT_ROLLUP_GRAIN,
    ROLLUP_GRAIN,
    event_sums,
    machine_copies,
    machine_repeats,
    reading_sums,
)
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Version
from plantlens.tables import Tables

T = TypeVar("T")


def sensor_rollup(sensors: DataFrame) -> DataFrame:
    """Clean readings reduced to (machine_id, date, status): additive parts only."""
    return sensors.groupBy(*ROLLUP_GRAIN).agg(*reading_sums())


def event_rollup(maintenance: DataFrame) -> DataFrame:
    """Clean events reduced to (machine_id, event_date, maintenance_type)."""
    return maintenance.groupBy(*EVENT_ROLLUP_GRAIN).agg(*event_sums())


def store(
    spark: SparkSession, df: DataFrame, path: str, *partition_by: str
) -> DataFrame:
    """Write ``df`` as Parquet (replacing ``path``), its schema beside it, and
    return it read back with that schema -- so an empty table, which a
    partitioned write leaves without any file to infer a schema from, still
    reads, in later sessions too."""
    schema = df.schema
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    write_schema(spark, schema, path)
    return spark.read.schema(schema).parquet(path)


def write_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Store the schema of the table at ``path`` beside it."""
    line = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    line.write.mode("overwrite").text(parquet.schema_path(path))


def together(*jobs: Callable[[], T]) -> list[T]:
    """The results of independent jobs, submitted at once: a short job does
    not wait for the last tasks of another one."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def write_aggregates(spark: SparkSession, tables: Tables, root: str) -> Tables:
    """Write the aggregate layer of ``tables`` below ``root`` (one pass over
    each table) and return ``tables`` with it attached, read from the files.

    Rollup rows per date are about machines x statuses, evenly sized; the
    ``rebalance`` hint lets AQE size the written files.
    """
    tables_of = {
        parquet.ROLLUP: lambda: sensor_rollup(tables.sensors).hint("rebalance", "date"),
        parquet.EVENT_ROLLUP: lambda: event_rollup(tables.maintenance).hint("rebalance", "event_date"),
        parquet.MACHINE_COPIES: lambda: machine_copies(tables.machines),
        parquet.MACHINE_REPEATS: lambda: machine_repeats(tables.machines),
    }
    return tables.with_aggregates(*together(*(
        partial(_store_made, spark, make, parquet.table_path(root, name), parquet.DAYS.get(name))
        for name, make in tables_of.items()
    )))


def _store_made(spark: SparkSession, make: Callable[[], DataFrame], path: str, day: str | None) -> DataFrame:
    return store(spark, make(), path, *([day] if day else []))


def write_curated(spark: SparkSession, clean: Tables, root: str, facts: dict | None = None) -> Tables:
    """Write the clean tables and the aggregate layer to a new version folder
    below ``root``; return them read back from the files (with the aggregate
    layer attached). Readers see the version once all of it is written; a
    failed run leaves the one before in place. ``facts`` go into its record.

    Readings are rebalanced on ``date`` before the write (the AQE
    ``rebalance`` hint): one shuffle, after which AQE splits any date whose
    partition is larger than the advisory size into several tasks and
    merges small ones. So each task writes few, well-sized files, a date
    that holds a large share of all rows is still written in parallel, and
    no sampling pass over the input is needed (range partitioning would
    read the input twice). Within a task rows are sorted by (date,
    machine_id, timestamp), so Parquet min/max statistics let a machine
    filter skip row groups.
    """
    base, version = root, versions.begin()
    root = os.path.join(base, version)
    tables_of = {
        parquet.SENSORS: lambda: clean.sensors.hint("rebalance", "date").sortWithinPartitions(
            "date", "machine_id", "timestamp"
        ),
        parquet.MACHINES: lambda: clean.machines,
        parquet.MAINTENANCE: lambda: clean.maintenance.hint("rebalance", "event_date").sortWithinPartitions(
            "event_date", "machine_id"
        ),
    }
    written = Tables(*together(*(
        partial(_store_made, spark, make, parquet.table_path(root, name), parquet.DAYS.get(name))
        for name, make in tables_of.items()
    )))
    # The aggregates are computed from the written tables, not the source.
    curated = write_aggregates(spark, written, root)
    versions.commit(spark, base, Version(version, versions.session_zone(spark), facts=facts or {}))
    return curated
