"""Cleaning: parse dates and timestamps, drop rows missing required values.

Parsing uses the ``try_`` functions, so bad text becomes NULL instead of
failing the job under ANSI mode; the row is then dropped with the other
incomplete rows. "Missing" means NULL, or NaN in a floating column (the
rule of ``DataFrame.dropna``); it is written as per-column predicates so
that the Parquet scan can push the NULL checks down.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.functions import as_date, as_timestamp, present
from plantlens.tables import Tables


def drop_incomplete(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Rows of ``df`` with a value (not NULL, not NaN) in every ``required``."""
    schema = df.schema  # one round trip for all columns
    return df.filter(reduce(and_, (present(c, schema[c].dataType) for c in required)))


def clean_sensors(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn("timestamp", as_timestamp(raw, "timestamp"))
    dated = parsed.withColumn("date", as_date(parsed, "timestamp"))
    return drop_incomplete(dated, S.SENSOR_REQUIRED)


def clean_machines(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn("install_date", as_date(raw, "install_date"))
    return drop_incomplete(parsed, S.MACHINE_REQUIRED)


def clean_maintenance(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn("event_date", as_date(raw, "event_date"))
    return drop_incomplete(parsed, S.MAINTENANCE_REQUIRED)


def clean(raw: Tables) -> Tables:
    """All three tables cleaned (an aggregate layer, if any, is already
    clean and stays)."""
    return replace(
        raw,
        sensors=clean_sensors(raw.sensors),
        machines=clean_machines(raw.machines),
        maintenance=clean_maintenance(raw.maintenance),
    )


def rejects(raw: Tables) -> DataFrame:
    """(table, reason, rows): rows that ``clean`` drops, by the required
    column that holds no value after parsing (a row may count for several),
    and all of them under the reason ``any``."""
    tables = (
        ("sensors", raw.sensors, "timestamp", as_timestamp, S.SENSOR_REQUIRED),
        ("machines", raw.machines, "install_date", as_date, S.MACHINE_REQUIRED),
        ("maintenance", raw.maintenance, "event_date", as_date, S.MAINTENANCE_REQUIRED),
    )
    counts = []
    for name, df, column, parse, required in tables:
        parsed = df.withColumn(column, parse(df, column))
        schema = parsed.schema
        missing = {c: ~present(c, schema[c].dataType) for c in required}
        every = {**missing, "any": reduce(or_, missing.values())}
        row = parsed.agg(*[F.count_if(test).alias(c) for c, test in every.items()])
        long = row.unpivot([], list(every), "reason", "rows")
        counts.append(long.select(F.lit(name).alias("table"), "reason", "rows"))
    return reduce(DataFrame.unionByName, counts)
