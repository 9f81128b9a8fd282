"""Incremental ingest of sensor readings with Structured Streaming.

New raw sensor files (CSV or Parquet) landing in a folder are cleaned with
the batch clean step and added to the curated layer, so dashboards over it
stay current without a full rebuild. One streaming query reads each new
file once; for every micro-batch (``foreachBatch``, batch persisted for
its two writes) it writes, below ``<root>/stream``,

* the clean readings to ``sensors/source=<id>/batch=<n>/date=<day>/``, and
* the batch's rollup increment -- partial aggregates at (machine_id, date,
  status) -- to ``sensor_rollup/source=<id>/batch=<n>/date=<day>/``.

The source id is drawn once per checkpoint folder and kept in it, so
streams with checkpoints of their own never write to each other's folders. A
batch replayed after a driver or executor failure has the same id and the
same files, and replaces its own output: each reading lands exactly once. A
stream whose checkpoint is lost starts anew as another source; its files
land a second time unless the old source's folders are removed first.

The rollup is additive, so rows of the same grain from different batches
simply sum up when the operators re-aggregate it -- no merge step, no state
store, no watermark, and no reading is dropped for being late.

A batch counts once its record is there, written after both tables: readers
never see the readings of a batch without its increment. Files of a batch
with a record are not written again.

``streamed_tables`` joins the increments to the curated layer below the same
root, those aside that the layer already holds (``plans.compact`` folds them
into it). ``compact_rollup`` folds the increments into one table.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plantlens import schemas as S
from plantlens.operators.clean import clean_sensors
from plantlens.operators.measures import ROLLUP_GRAIN, SENSOR_SUMS, machine_copies, machine_repeats
from plantlens.plans.curated import event_rollup, sensor_rollup, store
from plantlens.sources import parquet, versions
from plantlens.tables import Tables

RECORDS = "landed"  # folder of the records of landed batches
STREAMED = "streamed"  # a version's fact: the last batch of each source that it holds


def sensor_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw readings from files arriving in ``landing`` (declared schema)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing)


def _stream_path(curated_root: str, name: str) -> str:
    return os.path.join(curated_root, "stream", name)


def _source_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream with this checkpoint, drawn at its first start."""
    path = os.path.join(checkpoint, "source-id")
    found = parquet.first_text(spark, path)
    if found is None:
        found = "s" + uuid.uuid4().hex
        spark.createDataFrame([(found,)], "value string").coalesce(1).write.text(path)
    return found


def _record_path(curated_root: str, source: str, batch: int) -> str:
    return os.path.join(_stream_path(curated_root, RECORDS), f"{source}-{batch}")


def _ingest_batch(curated_root: str, source: str):
    sensors = _stream_path(curated_root, parquet.SENSORS)
    rollup = _stream_path(curated_root, parquet.ROLLUP)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        record = _record_path(curated_root, source, batch_id)
        if parquet.first_text(spark, record) is not None:  # a replay
            return
        batch.persist()
        try:
            if batch.isEmpty():
                return
            folder = os.path.join(f"source={source}", f"batch={batch_id}")
            (
                batch.hint("rebalance", "date")
                .write.mode("overwrite")
                .partitionBy("date")
                .parquet(os.path.join(sensors, folder))
            )
            (
                sensor_rollup(batch)
                .hint("rebalance", "date")
                .write.mode("overwrite")
                .partitionBy("date")
                .parquet(os.path.join(rollup, folder))
            )
            line = spark.createDataFrame([(f"{source} {batch_id}",)], "value string").coalesce(1)
            line.write.mode("overwrite").text(record)
        finally:
            batch.unpersist()

    return write


def start_ingest(
    raw_readings: DataFrame,
    curated_root: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the ingest query over the cleaned stream.

    ``available_now`` processes what has landed and stops (scheduled jobs);
    otherwise ``processing_time`` (e.g. "1 minute") runs continuously.
    """
    source = _source_id(raw_readings.sparkSession, checkpoint)
    writer = (
        clean_sensors(raw_readings)
        .writeStream.foreachBatch(_ingest_batch(curated_root, source))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def landed(spark: SparkSession, curated_root: str, covered: dict[str, int]) -> dict[str, list[int]]:
    """The batches of each source that have landed beyond the last one
    ``covered`` (a list as long as the batches since then)."""
    try:
        records = spark.read.option("recursiveFileLookup", True).text(_stream_path(curated_root, RECORDS))
    except AnalysisException:  # nothing has landed
        return {}
    source, batch = F.substring_index("value", " ", 1), F.substring_index("value", " ", -1).cast("bigint")
    found = records.select(source.alias("source"), batch.alias("batch"))
    past = [(F.col("source") == s) & (F.col("batch") <= to) for s, to in covered.items()]
    if past:
        found = found.where(~reduce(Column.__or__, past))
    per_source = found.groupBy("source").agg(F.sort_array(F.collect_set("batch")).alias("batches"))
    row = per_source.agg(F.map_from_entries(F.collect_list(F.struct("source", "batches")))).first()
    return row[0]


def increments(spark: SparkSession, curated_root: str, name: str, batches: dict[str, list[int]]) -> DataFrame:
    """What some batches have added to a table. Only their folders are listed."""
    path = _stream_path(curated_root, name)
    folders = [os.path.join(path, f"source={s}", f"batch={b}") for s, own in sorted(batches.items()) for b in own]
    return spark.read.option("basePath", path).parquet(*folders).drop("source", "batch")


def streamed_tables(
    spark: SparkSession,
    curated_root: str,
    machines: DataFrame | None = None,
    maintenance: DataFrame | None = None,
) -> Tables:
    """The tables a dashboard reads after ingest, with the whole aggregate
    layer: the newest curated layer below the root, if there is one, and
    what the streams added. Without a curated layer ``machines`` and
    ``maintenance`` (clean) are needed."""
    curated = parquet.checked_version(spark, curated_root)
    if curated is not None:
        base = parquet.read_tables(spark, curated_root, with_aggregates=True, version=curated.name)
    elif machines is None or maintenance is None:
        raise ValueError(f"{curated_root} has no curated layer: pass machines and maintenance")
    else:
        nothing = clean_sensors(spark.createDataFrame([], S.SENSOR_CSV))
        base = Tables(
            sensors=nothing, machines=machines, maintenance=maintenance, rollup=sensor_rollup(nothing),
            event_rollup=event_rollup(maintenance), machine_copies=machine_copies(machines),
            machine_repeats=machine_repeats(machines),
        )
    batches = landed(spark, curated_root, curated.facts.get(STREAMED, {}) if curated else {})
    if not batches:
        return base
    sensors = increments(spark, curated_root, parquet.SENSORS, batches)
    rollup = increments(spark, curated_root, parquet.ROLLUP, batches)
    if curated is None:
        return replace(base, sensors=sensors, rollup=rollup)
    return replace(
        base,
        sensors=base.sensors.unionByName(sensors, allowMissingColumns=True),
        rollup=base.rollup.unionByName(rollup),
    )


def compact_rollup(spark: SparkSession, curated_root: str, out: str) -> DataFrame:
    """Fold the increments into one rollup at the grain (batch job); returns
    it read back from ``out``."""
    increments = spark.read.parquet(_stream_path(curated_root, parquet.ROLLUP))
    merged = increments.groupBy(*ROLLUP_GRAIN).agg(*[F.sum(c).alias(c) for c in SENSOR_SUMS])
    return store(spark, merged.hint("rebalance", "date"), out, "date")
