"""Corrections by day: a new version that writes the corrected days only.

``replace_days`` takes the clean rows of some days, writes them with their
rollup days to a new version folder, and commits a version whose other days
are those of the version before (``sources.versions.Part``). Work and
written bytes follow the corrected days, not the table; the machine tables
and what derives from them are taken over as they are.

A version that was corrected n times is read from up to n + 1 folders per
table, each of them pruned to its own days; ``plans.compact.rewrite`` makes
one folder of it again.

A correction builds on the version that was current when it began. If
another one has been committed meanwhile it is refused (``Superseded``), so
that neither undoes the other; it can be run again.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.plans.curated import event_rollup, sensor_rollup, store
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Part, Version
from plantlens.tables import Tables

# Each table kept by day with the rollup made of it.
ROLLUPS = {
    parquet.SENSORS: (parquet.ROLLUP, sensor_rollup),
    parquet.MAINTENANCE: (parquet.EVENT_ROLLUP, event_rollup),
}
TAKEN_OVER = (parquet.MACHINES, parquet.MACHINE_COPIES, parquet.MACHINE_REPEATS)


class Superseded(RuntimeError):
    """Another version was committed while a correction was being written."""


def days_of(rows: DataFrame, day: str) -> list[str]:
    """The days of some rows (a list as long as the days)."""
    found = rows.agg(F.collect_set(F.col(day).cast("string"))).first()[0]
    return sorted(found)


def _text(days: Iterable[dt.date | str]) -> list[str]:
    return sorted({dt.date.fromisoformat(str(d)).isoformat() for d in days})


def replace_days(
    spark: SparkSession,
    root: str,
    sensors: DataFrame | None = None,
    maintenance: DataFrame | None = None,
    days: Iterable[dt.date | str] | None = None,
) -> Version:
    """Commit a version in which the given days of the readings, the events
    or both are replaced by the clean rows given; a table not given stays.

    ``days``: the days to replace, without rows in the new ones if none are
    given for them; all days that occur in the rows by default. Rows of
    other days are left out.
    """
    before = parquet.checked_version(spark, root)
    if before is None:
        raise LookupError(f"{root} has no committed version to correct")
    name = versions.begin()
    folder = os.path.join(root, name)
    asked = None if days is None else _text(days)
    parts = {t: before.table(t) for t in (*ROLLUPS, *(r for r, _ in ROLLUPS.values()), *TAKEN_OVER)}
    changed: dict[str, list[str]] = {}
    for table, rows in ((parquet.SENSORS, sensors), (parquet.MAINTENANCE, maintenance)):
        if rows is None:
            continue
        day = parquet.DAYS[table]
        own = days_of(rows, day) if asked is None else asked
        if not own:
            continue
        changed[table] = own
        rollup, reduce_rows = ROLLUPS[table]
        new = rows.where(F.col(day).cast("string").isin(*own))
        inside = [day, "machine_id"] + (["timestamp"] if "timestamp" in rows.columns else [])
        written = store(
            spark, new.hint("rebalance", day).sortWithinPartitions(*inside), os.path.join(folder, table), day
        )
        store(spark, reduce_rows(written).hint("rebalance", day), os.path.join(folder, rollup), day)
        for target in (table, rollup):
            kept = [left for p in parts[target] if (left := p.minus(own)) is not None]
            parts[target] = (Part(os.path.join(name, target), only=tuple(own)), *kept)
    if not changed:
        return before
    now = versions.current(spark, root)
    if now is None or now.name != before.name:
        raise Superseded(f"{root} has gone on from {before.name}")
    return versions.commit(
        spark, root, Version(name, before.zone, before.name, parts, before.lasting() | {"corrected": changed})
    )


def corrected(spark: SparkSession, root: str, clean: Tables, days: Iterable[dt.date | str] | None = None) -> Tables:
    """``replace_days`` of readings and events; the tables read again."""
    version = replace_days(spark, root, clean.sensors, clean.maintenance, days)
    return parquet.read_tables(spark, root, with_aggregates=True, version=version.name)
