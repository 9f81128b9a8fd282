"""A curated version whose tables are bucketed by machine.

Readings, events and machines are written in the same number of buckets by
a hash of machine_id (readings and events by day as well). Two plans gain:

* a filter on one machine opens the files of one bucket of each day only,
  and reads, as their rows are sorted, few pages of them;
* readings and events join the machines bucket by bucket, without an
  exchange of either side, however large the machine table is.

Files: the rows are rebalanced on (day, bucket), so a day's bucket is one
file, and AQE splits a bucket that is too large, as that of a machine with a
large share of all readings.

Such a machine would make its bucket's join task large, and Spark cannot
split a join that has no exchange. So the write notes the hot machines:
those with more than 1 / buckets of all readings or events, hence fewer
than twice the buckets. Their rows are joined apart: the dimension rows of
the hot machines, if their counted number is small, are broadcast, and the
scan's own splits are the tasks. The rest joins by bucket.

The folder is an ordinary version: ``sources.parquet`` reads the same files
without buckets. Buckets are known to Spark by a catalog table over the
folder, which ``read_bucketed`` creates in the session's catalog if it does
not have it.
"""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.plans.curated import write_aggregates, write_schema
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Version
from plantlens.tables import Tables

BUCKETS = 64
HOT_ROWS = 10_000  # dimension rows of hot machines that may be broadcast
KEY = "machine_id"
TABLES = (parquet.SENSORS, parquet.MACHINES, parquet.MAINTENANCE)
SORTED = {parquet.SENSORS: (KEY, "timestamp"), parquet.MAINTENANCE: (KEY,), parquet.MACHINES: (KEY,)}


def catalog_name(version: str, table: str) -> str:
    """The name of a bucketed table in the session's catalog."""
    return f"plantlens_{version.replace('-', '_')}_{table}"


def bucket(buckets: int) -> Column:
    """The bucket of a row, as Spark numbers buckets."""
    return F.pmod(F.hash(KEY), F.lit(buckets))


def _write(spark: SparkSession, df: DataFrame, version: str, table: str, path: str, buckets: int) -> None:
    day = parquet.DAYS.get(table)
    days = [day] if day else []
    columns = [c for c in df.columns if c != day] + days
    rows = df.select(columns).withColumn("_bucket", bucket(buckets)).hint("rebalance", *days, "_bucket")
    writer = rows.drop("_bucket").write.format("parquet").option("path", path)
    if day:
        writer = writer.partitionBy(day)
    writer.bucketBy(buckets, KEY).sortBy(*SORTED[table]).saveAsTable(catalog_name(version, table))
    write_schema(spark, df.select(columns).schema, path)


def hot_machines(tables: Tables, buckets: int) -> list[str]:
    """Machines with more than 1 / buckets of all readings or events."""
    found: set[str] = set()
    for sums, rows in ((tables.rollup, "readings"), (tables.event_rollup, "events")):
        per_machine = sums.groupBy(KEY).agg(F.sum(rows).alias("own"))
        total = per_machine.agg(F.sum("own")).first()[0] or 0
        # Fewer than ``buckets`` machines can pass.
        row = per_machine.where(F.col("own") * buckets > total).agg(F.collect_set(KEY)).first()
        found.update(row[0])
    return sorted(found)


def write_bucketed(spark: SparkSession, clean: Tables, root: str, buckets: int = BUCKETS) -> Tables:
    """Write the clean tables and their aggregates as a bucketed version
    below ``root``, commit it, and return it as ``read_bucketed`` does."""
    name = versions.begin()
    folder = os.path.join(root, name)
    for table in TABLES:
        _write(spark, getattr(clean, table), name, table, os.path.join(folder, table), buckets)
    written = Tables(*(parquet.read_table(spark, folder, t) for t in TABLES))
    written = write_aggregates(spark, written, folder)
    hot = hot_machines(written, buckets)
    rows = written.machine_copies.where(F.col(KEY).isin(*hot)).agg(F.sum("copies")).first()[0] if hot else 0
    facts = {"buckets": buckets, "hot": hot, "hot_rows": rows or 0}
    versions.commit(spark, root, Version(name, versions.session_zone(spark), facts=facts))
    return read_bucketed(spark, root, name)


def _attach(spark: SparkSession, root: str, version: Version, table: str) -> DataFrame:
    """The catalog table over a version's folder, created if need be."""
    name, path = catalog_name(version.name, table), os.path.join(root, version.name, table)
    if not spark.catalog.tableExists(name):
        schema = parquet.stored_schema(spark, path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        day = parquet.DAYS.get(table)
        parted = f"PARTITIONED BY (`{day}`)" if day else ""
        order = ", ".join(SORTED[table])
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parted} CLUSTERED BY ({KEY}) SORTED BY ({order})"
            f" INTO {version.facts['buckets']} BUCKETS LOCATION '{path}'"
        )
        if day:
            spark.catalog.recoverPartitions(name)  # the days' folders
    return spark.table(name)


def read_bucketed(spark: SparkSession, root: str, name: str | None = None) -> Tables:
    """The current version below ``root``, or the one named, with its
    buckets and aggregates."""
    version = parquet.checked_version(spark, root, name)
    if version is None or "buckets" not in version.facts:
        raise LookupError(f"{root} has no bucketed version" + (f" {name}" if name else ""))
    plain = parquet.read_tables(spark, root, with_aggregates=True, version=version.name)
    own = {t: _attach(spark, root, version, t) for t in TABLES}
    return replace(
        plain, **own, hot=tuple(version.facts["hot"]), hot_is_small=version.facts["hot_rows"] <= HOT_ROWS
    )
