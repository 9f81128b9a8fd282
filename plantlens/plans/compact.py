"""Compaction: what the streams have added becomes part of the curated layer.

A stream leaves a folder for each batch and day (``streaming.ingest``).
``compact`` folds all batches that have landed since the last compaction
into one folder of readings and one of rollup rows, summed up at the grain,
and commits a version that has these folders as further parts and says up to
which batch of each source it holds them. Swapping the parts for the batches
is that one record: a reader takes either the version before with the
batches, or the new one without them, and so counts every reading once at any
moment. The batches' folders are not read any more and can be removed.

Work follows what has landed, not the layer. After ``max_parts`` compactions
their parts are folded into one along with the new batches, so a table is read
from few folders and a row is rewritten once in ``max_parts`` compactions.

A compaction builds on the version that was current when it began; if
another one has been committed meanwhile it is refused (``Superseded``) and
can be run again. ``write_curated`` of the sources makes a version that holds
no batch: what the streams added counts beside it as before. ``rewrite`` makes
one folder per table of the current version and keeps what it holds.

Defined results: without landed batches, or with batches all held, nothing is
written and the version stays. Rows of a day that was corrected after its
batch had been compacted stay replaced; batches that land later add to it.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.measures import ROLLUP_GRAIN, SENSOR_SUMS
from plantlens.plans.correct import ROLLUPS, TAKEN_OVER, Superseded
from plantlens.plans.curated import store, write_curated
from plantlens.sources import parquet, versions
from plantlens.sources.versions import Part, Version
from plantlens.streaming.ingest import STREAMED, increments, landed
from plantlens.tables import Tables

COMPACTED = "compacted"  # a version's fact: the folders that compactions made
MAX_PARTS = 8


def _folded(name: str, rows: DataFrame) -> DataFrame:
    """The rows as a part is written: readings sorted for row-group
    skipping, rollup rows summed up at the grain."""
    if name == parquet.ROLLUP:
        return rows.groupBy(*ROLLUP_GRAIN).agg(*[F.sum(c).alias(c) for c in SENSOR_SUMS]).hint("rebalance", "date")
    return rows.hint("rebalance", "date").sortWithinPartitions("date", "machine_id", "timestamp")


def compact(spark: SparkSession, root: str, max_parts: int = MAX_PARTS) -> Version:
    """Fold the landed batches below ``root`` into its curated layer; return
    the version that is current then."""
    before = parquet.checked_version(spark, root)
    if before is None:
        raise LookupError(f"{root} has no committed version to compact into")
    held = before.facts.get(STREAMED, {})
    batches = landed(spark, root, held)
    if not batches:
        return before
    name = versions.begin()
    made = list(before.facts.get(COMPACTED, []))
    folding = set(made) if len(made) >= max_parts else set()
    tables = (*ROLLUPS, *(rollup for rollup, _ in ROLLUPS.values()), *TAKEN_OVER)
    parts = {table: before.table(table) for table in tables}
    for table in (parquet.SENSORS, parquet.ROLLUP):
        old = [p for p in parts[table] if os.path.dirname(p.folder) in folding]
        rows = [p.rows(parquet.read_path(spark, os.path.join(root, p.folder)), "date") for p in old]
        rows.append(increments(spark, root, table, batches))
        every = reduce(lambda one, more: one.unionByName(more, allowMissingColumns=True), rows)
        store(spark, _folded(table, every), os.path.join(root, name, table), "date")
        parts[table] = (*(p for p in parts[table] if p not in old), Part(os.path.join(name, table)))
    facts = {
        STREAMED: held | {source: max(own) for source, own in batches.items()},
        COMPACTED: [*(m for m in made if m not in folding), name],
    }
    now = versions.current(spark, root)
    if now is None or now.name != before.name:
        raise Superseded(f"{root} has gone on from {before.name}")
    return versions.commit(spark, root, Version(name, before.zone, before.name, parts, facts))


def rewrite(spark: SparkSession, root: str) -> Tables:
    """The current version as one folder per table; its tables."""
    before = parquet.checked_version(spark, root)
    if before is None:
        raise LookupError(f"{root} has no committed version to rewrite")
    tables = parquet.read_tables(spark, root, version=before.name)
    held = {STREAMED: before.facts[STREAMED]} if STREAMED in before.facts else {}
    return write_curated(spark, tables, root, held)
