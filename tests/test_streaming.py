"""Streaming ingest: many micro-batches and a restart give the batch results."""

from __future__ import annotations

from dataclasses import replace

from compare import spark_rows
from plants import SF001

from plantlens.operators import Filters, kpis, latest_readings, machine_health, status_distribution
from plantlens.operators.clean import clean
from plantlens.plans.curated import write_curated
from plantlens.session import fresh_dir
from plantlens.sources.bind import bind
from plantlens.streaming import compact_rollup, sensor_stream, start_ingest, streamed_tables


def test_incremental_ingest_matches_batch(spark):
    raw = bind(spark, SF001)
    landing = fresh_dir(spark, "test-landing")
    raw.sensors.repartition(4).write.parquet(landing)  # four files -> four batches
    schema = spark.read.parquet(landing).schema
    root, checkpoints = fresh_dir(spark, "test-streamed"), fresh_dir(spark, "test-ckpt")

    def ingest():
        stream = sensor_stream(spark, landing, schema, max_files_per_trigger=1)
        start_ingest(stream, root, checkpoints).awaitTermination()

    ingest()
    ingest()  # restart from the checkpoints: nothing is processed twice
    direct = clean(raw)
    streamed = streamed_tables(spark, root, direct.machines, direct.maintenance)
    written = spark.read.parquet(f"{root}/stream/sensor_rollup")
    assert written.select("source", "batch").distinct().count() == 4
    assert streamed.has_aggregates and set(streamed.sensors.columns) == set(direct.sensors.columns)

    for f in (Filters(), Filters(factory="ASIA", start_date="2024-01-03", end_date="2024-01-20")):
        for op in (kpis, machine_health, status_distribution):
            assert spark_rows(op(streamed, f)) == spark_rows(op(direct, f)), op.__name__

    compacted = streamed.with_rollup(
        compact_rollup(spark, root, fresh_dir(spark, "test-compacted"))
    )
    assert spark_rows(machine_health(compacted)) == spark_rows(machine_health(direct))
    assert streamed.sensors.count() == direct.sensors.count()


def test_streams_add_to_the_curated_layer(spark):
    """Half of the readings curated, the rest from two streams with their
    own checkpoints: all results as from all readings at once."""
    raw = bind(spark, SF001)
    direct = clean(raw)
    root = fresh_dir(spark, "test-mixed")
    part = raw.sensors.where("reading_id % 4 < 2")
    write_curated(spark, clean(replace(raw, sensors=part)), root)
    before = streamed_tables(spark, root)
    assert before.sensors.count() < direct.sensors.count()  # nothing has landed
    for k in (2, 3):
        landing = fresh_dir(spark, "test-landing")
        raw.sensors.where(f"reading_id % 4 = {k}").write.parquet(landing)
        stream = sensor_stream(spark, landing, spark.read.parquet(landing).schema)
        start_ingest(stream, root, fresh_dir(spark, "test-ckpt")).awaitTermination()
    streamed = streamed_tables(spark, root)
    assert streamed.has_aggregates and "batch" not in streamed.sensors.columns
    for op in (kpis, machine_health, status_distribution, latest_readings):
        assert spark_rows(op(streamed)) == spark_rows(op(direct)), op.__name__
