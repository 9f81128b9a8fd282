"""One entry point for the three input tables (S4).

``load(spark, source_dir, fmt)`` reads the raw tables from a folder:

* ``fmt="csv"``: ``sensor_readings.csv``, ``machines.csv`` and
  ``maintenance_events.csv`` (files or folders of parts), header row,
  declared schemas;
* ``fmt="parquet"``: ``sensors/``, ``machines/``, ``maintenance/``.

The result is uncleaned; pass it to ``operators.clean``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from plantlens.sources import csv, parquet
from plantlens.tables import Tables

# File names of the CSV input layout.
CSV_FILES = ("sensor_readings.csv", "machines.csv", "maintenance_events.csv")


def load(spark: SparkSession, source_dir: str, fmt: str = "csv") -> Tables:
    if fmt == "csv":
        sensors, machines, maintenance = (os.path.join(source_dir, f) for f in CSV_FILES)
        return csv.read_tables(spark, sensors, machines, maintenance)
    if fmt == "parquet":
        return parquet.read_tables(spark, source_dir)
    raise ValueError(f"unknown source format: {fmt!r} (csv or parquet)")


def load_cells(spark: SparkSession, source_dir: str, fmt: str = "csv") -> Tables:
    """Like ``load``, with the cells of text files as they stand; the input
    of ``plans.load.load_curated``."""
    if fmt == "csv":
        return csv.read_table_cells(spark, *(os.path.join(source_dir, f) for f in CSV_FILES))
    return load(spark, source_dir, fmt)
