"""Load with quarantine: source files to a curated version in one scan each.

Every source table is scanned once. The judged rows (``operators.quarantine``)
are written partitioned by ``accepted`` and the table's day: the accepted
folder is the curated table, the other one the quarantine, with the defects
of every row. The same pass counts rows and defects (``DataFrame.observe``),
so neither needs a scan of its own.

Rows are rebalanced on the day, as in ``write_curated``: AQE splits large
days, and the quarantined rows of a bad file, however many, too.

The version is committed last. With ``max_rejected`` a load that rejects a
larger share of a table raises instead, and readers stay with the version
before; the quarantine of the refused load can be read by the name that the
error carries.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from plantlens.operators import quarantine as Q
from plantlens.plans.curated import store, together, write_aggregates
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Part, Version
from plantlens.tables import Tables

LOADED = "loaded"
COUNTS = "load_counts"
TABLES = (parquet.SENSORS, parquet.MACHINES, parquet.MAINTENANCE)


class TooManyRejected(ValueError):
    """A load that rejects more than its limit; ``version`` is not committed."""

    def __init__(self, version: str, shares: dict[str, float]):
        self.version = version
        self.shares = shares
        super().__init__(f"{version} rejects " + ", ".join(f"{s:.1%} of {t}" for t, s in shares.items()))


@dataclass(frozen=True)
class Loaded:
    """The tables of a load, with aggregates, and what it found."""

    version: str
    tables: Tables
    counts: dict[str, dict[str, int]]  # by table: rows, accepted, "column: problem"


def judged_path(root: str, version: str, table: str) -> str:
    return os.path.join(root, version, LOADED, table)


def _write(spark: SparkSession, raw: DataFrame, table: str, path: str) -> dict[str, int]:
    """Write the judged rows; their counts."""
    day = Q.RULES[table].day
    keys = [Q.ACCEPTED] + ([day] if day else [])
    inside = keys + [c for c in ("machine_id", "timestamp") if c in raw.columns]
    seen = Observation()
    marked = Q.marked(raw, table)
    rows = Q.parsed(marked.observe(seen, *Q.measures(marked, table)), table)
    written = store(spark, rows.hint("rebalance", *keys).sortWithinPartitions(*inside), path, *keys)
    # Tasks that run again after a lost executor are observed again, and no
    # rows are not observed at all; the files then tell (their row count is
    # in the footers).
    total = written.count()
    counts = dict(seen.get) if total else {}
    if counts.get("rows") != total:
        names = [c.removeprefix(Q.mark("")) for c in marked.columns if c.startswith(Q.mark(""))]
        counts = Q.recounted(written, table, names).first().asDict()
    return counts


def load_curated(spark: SparkSession, raw: Tables, root: str, max_rejected: float | None = None) -> Loaded:
    """Judge the raw tables (``sources.load_cells``), write what is accepted
    as a new version below ``root``, with its aggregate layer and the
    quarantine, and commit it."""
    version = versions.begin()
    found = together(*(partial(_write, spark, getattr(raw, t), t, judged_path(root, version, t)) for t in TABLES))
    counts = dict(zip(TABLES, found))
    shares = {t: 1 - n[Q.ACCEPTED] / n["rows"] for t, n in counts.items() if n["rows"]}
    over = {t: s for t, s in shares.items() if max_rejected is not None and s > max_rejected}
    if over:
        raise TooManyRejected(version, over)
    folder = os.path.join(root, version)
    parts = {t: (Part(os.path.join(version, LOADED, t), judged=True),) for t in TABLES}
    record = Version(version, versions.session_zone(spark), parts=parts, facts={"counts": counts})
    written = Tables(*(parquet.read_version(spark, root, record, t) for t in TABLES))
    rows = [(t, kind, n) for t, own in counts.items() for kind, n in own.items()]
    store(spark, spark.createDataFrame(rows, "table string, reason string, rows bigint"), os.path.join(folder, COUNTS))
    tables = write_aggregates(spark, written, folder)
    versions.commit(spark, root, record)
    return Loaded(version, tables, counts)


def quarantine(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """The rejected rows of a load: the current one below ``root``, or any
    by its name, committed or not."""
    if version is None:
        found = parquet.checked_version(spark, root)
        if found is None:
            raise LookupError(f"{root} has no committed load")
        version = found.name
    return Q.quarantined(parquet.read_path(spark, judged_path(root, version, table)))


def load_counts(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(table, reason, rows) of a load: ``rows``, ``accepted``, and rows per
    "column: problem"."""
    found = parquet.checked_version(spark, root, version)
    if found is None:
        raise LookupError(f"{root} has no committed load")
    return parquet.read_version(spark, root, found, COUNTS)
