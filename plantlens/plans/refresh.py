"""Dashboard refresh: every result of one filter choice, written as Parquet.

One call computes what a dashboard page shows for a ``Filters`` value --
filter choices, date bounds, KPIs, the six chart tables, the health table
with its counts, distribution and top-risk list, and the three previews --
and publishes them together. Nothing passes through the driver: the
returned manifest is a DataFrame of (result, rows) counted from the written
files.

A refresh writes into a version folder of its own and commits it when all
of it is there (``sources.versions``). A dashboard opens a publication
(``published``) and reads every result from it: all of one refresh, never
old and new mixed, whatever is published meanwhile; and a refresh that
fails or is killed changes nothing for readers. Earlier versions stay
readable by name until their folders are removed.

The facts are read once: unless the tables already carry the aggregate
layer (a curated layer does), it is written first (``write_aggregates``:
one pass over readings, events and dimension), and every aggregate result
is then a small re-aggregation of it. The health table feeds four
results, so it is written next and the other three read it; the date
bounds likewise feed the default date range.

The results are independent Spark jobs, mostly small; they are submitted
from a few driver threads at once, so the scheduler runs their stages
side by side instead of leaving executors idle between short jobs.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators import (
    Filters,
    chart_data,
    date_bounds,
    health_distribution,
    health_status_counts,
    kpis,
    latest_readings,
    machine_health,
    machine_master,
    maintenance_history,
    option_values,
    resolve_date_range,
    top_risk_machines,
)
from plantlens.plans.curated import write_aggregates
from plantlens.session import fresh_dir
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Version
from plantlens.tables import Tables

HEALTH = "machine_health"
MANIFEST = "manifest"


def _results(tables: Tables, filters: Filters) -> dict[str, Callable[[], DataFrame]]:
    """The results of one refresh, lazily (health-derived ones excluded)."""
    charts = chart_data(tables, filters)
    out: dict[str, Callable[[], DataFrame]] = {
        "options_factory": lambda: option_values(tables, "factory", filters),
        "options_production_line": lambda: option_values(tables, "production_line", filters),
        "options_model": lambda: option_values(tables, "model", filters),
        "options_machine": lambda: option_values(tables, "machine_id", filters),
        "kpis": lambda: kpis(tables, filters),
        "latest_readings": lambda: latest_readings(tables, filters),
        "maintenance_history": lambda: maintenance_history(tables, filters),
        "machine_master": lambda: machine_master(tables, filters),
    }
    for name, df in charts.items():
        out[name] = lambda df=df: df
    return out


def dashboard(tables: Tables, filters: Filters) -> dict[str, DataFrame]:
    """Every result of one dashboard view, lazily, for a caller that
    collects them (all are small: one row per day, machine, category...).
    ``refresh`` is the variant that writes them and shares intermediates."""
    scoped = resolve_date_range(tables, filters)
    health = machine_health(tables, scoped)
    out = {
        "date_bounds": date_bounds(tables),
        HEALTH: health,
        "health_status_counts": health_status_counts(health),
        "health_distribution": health_distribution(health),
        "top_risk_machines": top_risk_machines(health),
    }
    out.update({name: make() for name, make in _results(tables, scoped).items()})
    return out


def write_result(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a new folder and read back. A table that is not
    partitioned has a file, with its schema, even without rows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh(
    spark: SparkSession,
    tables: Tables,
    filters: Filters,
    out_dir: str,
    concurrent_jobs: int = 8,
) -> DataFrame:
    """Publish all results of ``filters`` below ``out_dir``; return the manifest."""
    if not tables.has_aggregates:
        tables = write_aggregates(spark, tables, fresh_dir(spark, "refresh-aggregates"))

    version = versions.begin()
    folder = os.path.join(out_dir, version)

    def write(name: str, make: Callable[[], DataFrame]) -> str:
        write_result(make(), os.path.join(folder, name))
        return name

    # The bounds are written first; the default date range then reads the
    # one-row file instead of scanning the readings again for every result.
    names = ["date_bounds", HEALTH]
    bounds = write_result(date_bounds(tables), os.path.join(folder, "date_bounds"))
    scoped = resolve_date_range(tables, filters, bounds)
    health = write_result(machine_health(tables, scoped), os.path.join(folder, HEALTH))

    pending = {
        "health_status_counts": lambda: health_status_counts(health),
        "health_distribution": lambda: health_distribution(health),
        "top_risk_machines": lambda: top_risk_machines(health),
        **_results(tables, scoped),
    }
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        names += list(pool.map(lambda item: write(*item), pending.items()))
    counts = write_result(manifest(spark, folder, names), os.path.join(folder, MANIFEST))
    record = Version(version, versions.session_zone(spark), facts={"results": names, "filters": described(filters)})
    versions.commit(spark, out_dir, record)
    return counts


def described(filters: Filters) -> dict[str, str | None]:
    """The set filters as text, for the record of a publication; a date
    bound that is a subquery is left out."""
    names = ("factory", "production_line", "model", "machine_id", "status", "start_date", "end_date")
    values = {n: getattr(filters, n) for n in names}
    return {n: str(v) for n, v in values.items() if v is not None and not isinstance(v, Column)}


@dataclass(frozen=True)
class Publication:
    """One published refresh."""

    spark: SparkSession
    root: str
    version: Version

    @property
    def names(self) -> list[str]:
        return list(self.version.facts["results"])

    def result(self, name: str) -> DataFrame:
        """One result; a written table has no order, so a caller that shows
        it sorts it."""
        if name not in self.names:
            raise LookupError(f"{self.root} has no result {name}")
        return self._read(name)

    def manifest(self) -> DataFrame:
        return self._read(MANIFEST)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.root, self.version.name, name))

    def damaged(self) -> DataFrame:
        """(result, rows, found): results whose files no longer hold the rows
        of the manifest; none when all is well."""
        found = manifest(self.spark, os.path.join(self.root, self.version.name), self.names)
        both = self.manifest().join(found.withColumnRenamed("rows", "found"), "result", "left")
        return both.where(~F.col("rows").eqNullSafe(F.col("found")))


def published(spark: SparkSession, out_dir: str, version: str | None = None) -> Publication:
    """The newest publication below ``out_dir``, or the one of that name."""
    found = parquet.checked_version(spark, out_dir, version)
    if found is None:
        raise LookupError(f"nothing is published below {out_dir}" + (f" as {version}" if version else ""))
    return Publication(spark, out_dir, found)


def manifest(spark: SparkSession, out_dir: str, names: list[str]) -> DataFrame:
    """(result, rows) for each written result, counted from the files."""
    counts = [
        spark.read.parquet(os.path.join(out_dir, name)).agg(
            F.lit(name).alias("result"), F.count(F.lit(1)).alias("rows")
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)
