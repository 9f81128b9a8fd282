"""Compaction: the same results before and after, fewer files read, and each
reading counted once whatever is committed in between."""

from __future__ import annotations

from dataclasses import replace

import pytest
from compare import spark_rows
from plants import SF001, clean_tables, machine, raw_tables, reading
from pyspark.sql import functions as F

from plantlens.operators import daily_trend, kpis, latest_readings, machine_health
from plantlens.operators.clean import clean
from plantlens.plans import compact as K
from plantlens.plans.correct import Superseded, replace_days
from plantlens.plans.curated import write_curated
from plantlens.session import fresh_dir
from plantlens.sources import parquet, versions
from plantlens.sources.bind import bind
from plantlens.sources.versions import Version
from plantlens.streaming import ingest, sensor_stream, start_ingest, streamed_tables

OPS = (machine_health, daily_trend, latest_readings)


class Plant:
    """A curated layer of a quarter of the readings, and a landing folder."""

    def __init__(self, spark):
        self.spark, self.raw = spark, bind(spark, SF001)
        self.root, self.landing = fresh_dir(spark, "test-compact"), fresh_dir(spark, "test-landing")
        self.checkpoint = fresh_dir(spark, "test-ckpt")
        write_curated(spark, clean(replace(self.raw, sensors=self.quarter(0))), self.root)

    def quarter(self, k):
        return self.raw.sensors.where(f"reading_id % 4 = {k}")

    def stream(self, k, files=1, checkpoint=None):
        self.quarter(k).repartition(files).write.mode("append").parquet(self.landing)
        raw = sensor_stream(self.spark, self.landing, self.spark.read.parquet(self.landing).schema,
                            max_files_per_trigger=1)
        start_ingest(raw, self.root, checkpoint or self.checkpoint).awaitTermination()

    def files(self):
        return len(streamed_tables(self.spark, self.root).sensors.inputFiles())


def same(one, other):
    for op in OPS:
        assert spark_rows(op(one)) == spark_rows(op(other)), op.__name__


def test_results_stay_and_files_fall(spark):
    plant, right = Plant(spark), clean(bind(spark, SF001))
    for k in (1, 2, 3):
        plant.stream(k, files=3)
    many, grain = plant.files(), ("machine_id", "date", "status")
    same(streamed_tables(spark, plant.root), right)
    version = K.compact(spark, plant.root)
    same(streamed_tables(spark, plant.root), right)
    # The layer alone holds all now, in fewer files, one rollup row a grain in the new part.
    layer = parquet.read_tables(spark, plant.root, with_aggregates=True)
    same(layer, right)
    assert plant.files() == len(layer.sensors.inputFiles()) < many
    folded = spark.read.parquet(f"{plant.root}/{version.name}/sensor_rollup")
    assert folded.count() == folded.select(*grain).distinct().count()
    # Nothing new: nothing is written.
    assert K.compact(spark, plant.root) == versions.current(spark, plant.root) == version


def test_parts_are_folded_and_corrections_stay(spark):
    plant, right = Plant(spark), clean(bind(spark, SF001))
    plant.stream(1)
    first = K.compact(spark, plant.root, max_parts=2)
    # A correction of a day keeps what the layer holds of the stream.
    day = right.sensors.where(F.col("date") == "2024-01-10")
    wrong = day.withColumn("status", F.lit("OK"))
    replace_days(spark, plant.root, sensors=wrong)
    assert spark_rows(streamed_tables(spark, plant.root).sensors.where("date = '2024-01-10'").drop("reading_id")) \
        == spark_rows(wrong.drop("reading_id"))
    plant.stream(2)
    second = K.compact(spark, plant.root, max_parts=2)
    assert second.facts["compacted"] == [first.name, second.name]
    plant.stream(3)
    third = K.compact(spark, plant.root, max_parts=2)
    assert third.facts["compacted"] == [third.name]  # folded both
    for table in (parquet.SENSORS, parquet.ROLLUP):
        assert sum(p.folder.startswith((first.name, second.name)) for p in third.table(table)) == 0
    # The corrected day has the wrong rows and those that came later; the others are right.
    other = F.col("date") != "2024-01-10"
    now = streamed_tables(spark, plant.root)
    assert spark_rows(now.sensors.where(other)) == spark_rows(right.sensors.where(other))
    replace_days(spark, plant.root, sensors=day)
    same(streamed_tables(spark, plant.root), right)


def test_a_rewrite_keeps_what_is_held(spark):
    plant, right = Plant(spark), clean(bind(spark, SF001))
    plant.stream(1)
    K.compact(spark, plant.root)
    plant.stream(2)
    plant.stream(3)
    same(K.rewrite(spark, plant.root), replace(right, sensors=right.sensors.where("reading_id % 4 < 2")))
    assert versions.current(spark, plant.root).parts == {}
    same(streamed_tables(spark, plant.root), right)
    # A build of the sources holds no batch, so all of them count beside it.
    write_curated(spark, clean(replace(plant.raw, sensors=plant.quarter(0))), plant.root)
    same(streamed_tables(spark, plant.root), right)


def test_sources_with_checkpoints_of_their_own(spark):
    plant = Plant(spark)
    plant.stream(1)
    K.compact(spark, plant.root)
    plant.stream(2, checkpoint=fresh_dir(spark, "test-ckpt"))  # reads quarter 1 again, as another source
    held = K.compact(spark, plant.root).facts["streamed"]
    assert len(held) == 2 and all(s.startswith("s") for s in held)
    rows = clean(plant.raw).sensors
    expected = rows.where("reading_id % 4 < 3").unionByName(rows.where("reading_id % 4 = 1"))
    assert spark_rows(streamed_tables(spark, plant.root).sensors) == spark_rows(expected)


def test_a_batch_without_its_record_does_not_count(spark, monkeypatch):
    """A stream killed between its two tables leaves readings that nobody
    sees; its restart replaces them."""
    plant, right = Plant(spark), clean(bind(spark, SF001))
    before = spark_rows(kpis(streamed_tables(spark, plant.root)))

    def killed(rows):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(ingest, "sensor_rollup", killed)
        with pytest.raises(Exception, match="killed"):
            plant.stream(1)
    assert spark_rows(kpis(streamed_tables(spark, plant.root))) == before
    assert "streamed" not in K.compact(spark, plant.root).facts
    plant.stream(2)
    plant.stream(3)
    K.compact(spark, plant.root)
    same(streamed_tables(spark, plant.root), right)


def test_a_replayed_batch_is_not_written_again(spark):
    plant = Plant(spark)
    plant.stream(1)
    rows = streamed_tables(spark, plant.root).sensors.count()
    (source, batches), = ingest.landed(spark, plant.root, {}).items()
    ingest._ingest_batch(plant.root, source)(clean(plant.raw).sensors, batches[0])
    assert streamed_tables(spark, plant.root).sensors.count() == rows


def test_another_commit_refuses_the_compaction(spark, monkeypatch):
    plant = Plant(spark)
    plant.stream(1)
    rows = spark_rows(streamed_tables(spark, plant.root).sensors)
    real = K.store

    def meanwhile(session, df, path, *by):
        now = versions.current(session, plant.root)
        versions.commit(session, plant.root, Version(versions.begin(), now.zone, now.name,
                                                     {t: now.table(t) for t in (*parquet.DAYS, *K.TAKEN_OVER)}))
        return real(session, df, path, *by)

    with monkeypatch.context() as raced:
        raced.setattr(K, "store", meanwhile)
        with pytest.raises(Superseded):
            K.compact(spark, plant.root)
    assert spark_rows(streamed_tables(spark, plant.root).sensors) == rows
    K.compact(spark, plant.root)
    assert spark_rows(streamed_tables(spark, plant.root).sensors) == rows


def test_edges(spark):
    with pytest.raises(LookupError):
        K.compact(spark, fresh_dir(spark, "test-nothing"))
    with pytest.raises(LookupError):
        K.rewrite(spark, fresh_dir(spark, "test-nothing"))
    # An empty layer, and a stream whose readings are all dropped.
    root, landing = fresh_dir(spark, "test-empty"), fresh_dir(spark, "test-landing")
    empty = clean_tables(spark, machines=[machine("M1")])
    write_curated(spark, empty, root)
    first = versions.current(spark, root)
    raw_tables(spark, sensors=[reading(None)]).sensors.write.parquet(landing)
    checkpoint = fresh_dir(spark, "test-ckpt")
    schema = raw_tables(spark).sensors.schema
    start_ingest(sensor_stream(spark, landing, schema), root, checkpoint).awaitTermination()
    assert K.compact(spark, root) == first
    raw_tables(spark, sensors=[reading("M1"), reading("M1")]).sensors.write.mode("append").parquet(landing)
    start_ingest(sensor_stream(spark, landing, schema), root, checkpoint).awaitTermination()
    K.compact(spark, root)
    layer = parquet.read_tables(spark, root, with_aggregates=True)
    assert layer.sensors.count() == 2 and kpis(layer).first()["total_readings"] == 2
