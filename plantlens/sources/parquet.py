"""Columnar sources: the three tables as Parquet folders.

Layout of a table root: ``<root>/sensors``, ``<root>/machines``,
``<root>/maintenance`` (the curated layer in ``plans.curated`` writes the
same layout, sensors partitioned by ``date``).
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plantlens.sources import versions
from plantlens.sources.versions import Version
from plantlens.tables import Tables

SENSORS = "sensors"
MACHINES = "machines"
MAINTENANCE = "maintenance"
ROLLUP = "sensor_rollup"
EVENT_ROLLUP = "event_rollup"
MACHINE_COPIES = "machine_copies"
MACHINE_REPEATS = "machine_repeats"


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def schema_path(path: str) -> str:
    """Where the schema of the table at ``path`` is stored."""
    return os.path.join(os.path.dirname(path), "schemas", os.path.basename(path))


def first_text(spark: SparkSession, path: str) -> str | None:
    """The largest line of the text files at ``path``; None without any."""
    try:
        row = spark.read.text(path).agg({"value": "max"}).first()
    except AnalysisException:  # no such folder
        return None
    return row[0]


# The column a curated table is kept by, where it is kept by day.
DAYS = {SENSORS: "date", ROLLUP: "date", MAINTENANCE: "event_date", EVENT_ROLLUP: "event_date"}


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema stored beside the table at ``path``."""
    text = first_text(spark, schema_path(path))
    return T.StructType.fromJson(json.loads(text)) if text else None


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, by its stored schema if there is one: a table
    without rows has no file to infer a schema from."""
    schema = stored_schema(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table below ``root``."""
    return read_path(spark, table_path(root, name))


def read_version(spark: SparkSession, root: str, version: Version, name: str) -> DataFrame:
    """A table of a version: the rows of all its parts; a column that some
    parts lack is null there."""
    parts = [
        part.rows(read_path(spark, os.path.join(root, part.folder)), DAYS.get(name))
        for part in version.table(name)
    ]
    return reduce(lambda one, more: one.unionByName(more, allowMissingColumns=True), parts)


def checked_version(spark: SparkSession, root: str, name: str | None = None) -> Version | None:
    """The current version below ``root`` (or the one of that name); one
    written in another session time zone is refused: its dates would not be
    this session's."""
    version = versions.current(spark, root, name)
    own = versions.session_zone(spark)
    if version is not None and version.zone != own:
        raise ValueError(f"{root} was written in time zone {version.zone}, the session has {own}")
    return version


def read_tables(
    spark: SparkSession, root: str, with_aggregates: bool = False, version: str | None = None
) -> Tables:
    """The three tables of the current version below ``root``, or of the one
    named; of ``root`` itself without versions. With the aggregate layer if
    asked."""
    found = checked_version(spark, root, version)
    if found is None and version is not None:
        raise LookupError(f"{root} has no version {version}")

    def read(name: str) -> DataFrame:
        return read_table(spark, root, name) if found is None else read_version(spark, root, found, name)

    tables = Tables(*map(read, (SENSORS, MACHINES, MAINTENANCE)))
    if with_aggregates:
        tables = tables.with_aggregates(*map(read, (ROLLUP, EVENT_ROLLUP, MACHINE_COPIES, MACHINE_REPEATS)))
    return tables
