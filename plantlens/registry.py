"""Registered queries over the bound test tables, with their SQL oracles.

Each entry maps a name to a Spark callable ``(spark, sf_dir) -> DataFrame``
and, when the result is expressible in SQL, the DuckDB text that must give
the same rows (``plantlens.oracle``). Every query reads the whole bound
tables; the only row limits are the features' own (top 5, latest 500).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens import oracle as O
from plantlens import schemas as S
from plantlens.operators import (
    Filters,
    alerts_by_machine,
    clean,
    clean_machines,
    clean_maintenance,
    clean_sensors,
    daily_trend,
    date_bounds,
    downtime_by_factory,
    enrich_maintenance,
    enrich_sensors,
    health_distribution,
    health_status_counts,
    kpis,
    latest_readings,
    machine_health,
    machine_master,
    machine_metadata,
    machine_performance,
    maintenance_by_type,
    maintenance_history,
    option_values,
    prepare,
    resolve_date_range,
    series,
    status_distribution,
    top_risk_machines,
)
from plantlens.operators.clean import rejects
from plantlens.plans.bucketed import write_bucketed
from plantlens.plans.checks import duplicate_machines
from plantlens.plans.compact import compact
from plantlens.plans.correct import corrected
from plantlens.plans.curated import write_aggregates, write_curated
from plantlens.plans.load import load_counts, load_curated, quarantine
from plantlens.plans.refresh import published, refresh
from plantlens.session import fresh_dir
from plantlens.sources import csv, load, load_cells, parquet
from plantlens.sources.bind import bind
from plantlens.sources.loader import CSV_FILES
from plantlens.streaming import sensor_stream, start_ingest, streamed_tables
from plantlens.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Bound and cleaned tables of one scale-factor folder."""
    return clean(bind(spark, sf_dir))


def _on_tables(op: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(tables(spark, sf_dir))


# Filter sets of the registered queries (values in plantlens.oracle).
NONE = Filters()
FACTORY = Filters(factory=O.FACTORY)
LINE = Filters(production_line=O.LINE)
MODEL = Filters(model=O.MODEL)
MACHINE = Filters(machine_id=O.MACHINE)
STATUS = Filters(status=O.STATUS)
DATES = Filters(start_date=O.START, end_date=O.END)
OPEN_RANGE = Filters(start_date=O.START)  # one bound only: no date filter
COMBINED = Filters(**O.COMBINED)
SCOPED = Filters(**O.SCOPED)
NOWHERE = Filters(factory="NOWHERE")


# --- CSV round trip -------------------------------------------------------------


def _scan_csv(name: str) -> Query:
    """Write one bound table as CSV to a fresh shared folder, scan it back
    with the declared schema and clean it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = bind(spark, sf_dir)
        path = fresh_dir(spark, f"csv-{name}")
        csv.write_csv(getattr(raw, name), path)
        if name == "sensors":
            return clean_sensors(csv.read_sensors(spark, path))
        if name == "machines":
            return clean_machines(csv.read_machines(spark, path))
        return clean_maintenance(csv.read_maintenance(spark, path))

    return run


# --- streaming ingest -------------------------------------------------------------


def _streamed(op: Callable[[Tables], DataFrame]) -> Query:
    """Land the bound readings as Parquet files in a fresh shared folder,
    ingest them with the streaming job (clean -> curated readings + rollup
    increments), and run ``op`` over the streamed tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = bind(spark, sf_dir)
        landing = fresh_dir(spark, "landing")
        raw.sensors.write.parquet(landing)
        root = fresh_dir(spark, "streamed")
        stream = sensor_stream(spark, landing, spark.read.parquet(landing).schema)
        start_ingest(stream, root, fresh_dir(spark, "stream-checkpoint")).awaitTermination()
        clean_static = clean(raw)
        return op(streamed_tables(spark, root, clean_static.machines, clean_static.maintenance))

    return run


def _compacted(op: Callable[[Tables], DataFrame]) -> Query:
    """``op`` over a curated layer of a third of the readings, into which two
    compactions, the second folding the first, have taken the other thirds
    as they came in from a stream."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, root, landing = bind(spark, sf_dir), fresh_dir(spark, "compacted"), fresh_dir(spark, "landing")
        checkpoint = fresh_dir(spark, "stream-checkpoint")
        third = F.pmod(F.xxhash64(S.READING_ID), F.lit(3))
        write_curated(spark, clean(replace(raw, sensors=raw.sensors.where(third == 0))), root)
        for k in (1, 2):
            raw.sensors.where(third == k).write.mode("append").parquet(landing)
            stream = sensor_stream(spark, landing, spark.read.parquet(landing).schema)
            start_ingest(stream, root, checkpoint).awaitTermination()
            compact(spark, root, max_parts=1)
        return op(streamed_tables(spark, root))

    return run


def _narrow_default_range(t: Tables) -> DataFrame:
    """Events in the default range of a plant with readings of a few days."""
    few = replace(t, sensors=t.sensors.where(F.col("date").between(F.lit(O.START), F.lit(O.END))))
    return enrich_maintenance(few, resolve_date_range(few, NONE))


def _repeated(t: Tables) -> Tables:
    """The tables with some machines twice in the dimension."""
    twice = t.machines.where(F.col("machine_id").endswith("5"))
    return replace(t, machines=t.machines.unionByName(twice))


def _curated(op: Callable[[Tables], DataFrame]) -> Query:
    """``op`` over a fresh curated layer, read back as a later session does."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = fresh_dir(spark, "curated")
        write_curated(spark, tables(spark, sf_dir), root)
        return op(parquet.read_tables(spark, root, with_aggregates=True))

    return run


def _loaded(op: Callable[[Tables], DataFrame]) -> Query:
    """``op`` over the tables written as CSV files, loaded and cleaned."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, root = bind(spark, sf_dir), fresh_dir(spark, "csv")
        for df, name in zip((raw.sensors, raw.machines, raw.maintenance), CSV_FILES):
            csv.write_csv(df.drop(S.READING_ID), f"{root}/{name}")
        return op(clean(load(spark, root, "csv")))

    return run


def _with_unreadable(spark: SparkSession, sf_dir: str) -> str:
    """The tables as CSV files in which some cells are not what their
    column holds (values in plantlens.oracle); their folder."""
    raw, root = bind(spark, sf_dir), fresh_dir(spark, "csv-dirty")
    moment = F.date_format("timestamp", csv.TIMESTAMP_TEXT)
    never = F.col(S.READING_ID) % O.NEVER_EACH == 5
    none = F.col(S.READING_ID) % O.NO_ENERGY_EACH == 5
    dirty = raw.sensors.withColumns({
        "timestamp": F.when(never, O.NEVER).otherwise(moment),
        "energy_kwh": F.when(none, O.NO_ENERGY).otherwise(F.col("energy_kwh").cast("string")),
    })
    for df, name in zip((dirty, raw.machines, raw.maintenance), CSV_FILES):
        csv.write_csv(df, f"{root}/{name}")
    return root


def _judged(op: Callable[[SparkSession, str], DataFrame]) -> Query:
    """``op`` over the root of a fresh load with quarantine."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = fresh_dir(spark, "loaded")
        load_curated(spark, load_cells(spark, _with_unreadable(spark, sf_dir)), root)
        return op(spark, root)

    return run


def _listed(rejected: DataFrame) -> DataFrame:
    """Rejected readings with their defects as text."""
    text = F.transform("defects", lambda d: F.concat_ws(" ", d["column"], d["problem"], d["value"]))
    return rejected.select(S.READING_ID, "machine_id", "status", F.array_join(text, "; ").alias("defects"))


def _bucketed(op: Callable[[Tables], DataFrame]) -> Query:
    """``op`` over a fresh bucketed version."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(write_bucketed(spark, tables(spark, sf_dir), fresh_dir(spark, "bucketed"), buckets=8))

    return run


def _corrected(op: Callable[[Tables], DataFrame]) -> Query:
    """``op`` over a curated layer in which one day was wrong, in readings
    and events, and has been corrected."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        right, root = tables(spark, sf_dir), fresh_dir(spark, "corrected")
        on_day, of_day = F.col("date") == F.lit(O.START), F.col("event_date") == F.lit(O.START)
        wrong = replace(
            right,
            sensors=right.sensors.withColumn("status", F.when(~on_day, F.col("status"))),
            maintenance=right.maintenance.where(~of_day),
        )
        write_curated(spark, wrong, root)
        day = replace(right, sensors=right.sensors.where(on_day), maintenance=right.maintenance.where(of_day))
        return op(corrected(spark, root, day))

    return run


def _published(op: Callable[[SparkSession, Tables, str], DataFrame]) -> Query:
    """``op`` over the tables with aggregates and a fresh folder of views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        whole = write_aggregates(spark, tables(spark, sf_dir), fresh_dir(spark, "aggregates"))
        return op(spark, whole, fresh_dir(spark, "views"))

    return run


def _newest_kpis(spark: SparkSession, t: Tables, out: str) -> DataFrame:
    """The KPIs of the second of two published views."""
    for view in (SCOPED, FACTORY):
        refresh(spark, t, view, out)
    return published(spark, out).result("kpis")


def _pinned_health(spark: SparkSession, t: Tables, out: str) -> DataFrame:
    """The health table of a publication that another one has followed."""
    refresh(spark, t, SCOPED, out)
    pinned = published(spark, out)
    refresh(spark, t, FACTORY, out)
    return pinned.result("machine_health")


def _entries() -> dict[str, Entry]:
    e: dict[str, Entry] = {}

    def add(name: str, run: Query, sql: str | None) -> None:
        e[name] = Entry(run, sql)

    # sources and cleaning
    add("scan_sensors_csv", _scan_csv("sensors"), O.with_tables("\nSELECT * FROM sensors"))
    add("scan_machines_csv", _scan_csv("machines"), O.with_tables("\nSELECT * FROM machines"))
    # Minutes are read from text as numbers that may have decimals.
    add("scan_maintenance_csv", _scan_csv("maintenance"),
        O.with_tables("\nSELECT * REPLACE (CAST(downtime_minutes AS DOUBLE) AS downtime_minutes)"
                      " FROM maintenance"))
    add("clean_sensors", _on_tables(lambda t: t.sensors), O.with_tables("\nSELECT * FROM sensors"))
    add("clean_machines", _on_tables(lambda t: t.machines),
        O.with_tables("\nSELECT * FROM machines"))
    add("clean_maintenance", _on_tables(lambda t: t.maintenance),
        O.with_tables("\nSELECT * FROM maintenance"))

    # enrichment and filters
    add("enrich_sensors", _on_tables(enrich_sensors), O.sensor_rows_sql())
    add("enrich_maintenance", _on_tables(enrich_maintenance), O.maintenance_rows_sql())
    add("filter_factory", _on_tables(lambda t: enrich_sensors(t, FACTORY)),
        O.sensor_rows_sql(factory=O.FACTORY))
    add("filter_factory_maintenance", _on_tables(lambda t: enrich_maintenance(t, FACTORY)),
        O.maintenance_rows_sql(factory=O.FACTORY))
    add("filter_production_line", _on_tables(lambda t: enrich_sensors(t, LINE)),
        O.sensor_rows_sql(production_line=O.LINE))
    add("filter_model", _on_tables(lambda t: enrich_sensors(t, MODEL)),
        O.sensor_rows_sql(model=O.MODEL))
    add("filter_machine", _on_tables(lambda t: enrich_sensors(t, MACHINE)),
        O.sensor_rows_sql(machine_id=O.MACHINE))
    add("filter_machine_maintenance", _on_tables(lambda t: enrich_maintenance(t, MACHINE)),
        O.maintenance_rows_sql(machine_id=O.MACHINE))
    add("filter_status", _on_tables(lambda t: enrich_sensors(t, STATUS)),
        O.sensor_rows_sql(status=O.STATUS))
    add("filter_date_sensors", _on_tables(lambda t: enrich_sensors(t, DATES)),
        O.sensor_rows_sql(start_date=O.START, end_date=O.END))
    add("filter_date_maintenance", _on_tables(lambda t: enrich_maintenance(t, DATES)),
        O.maintenance_rows_sql(start_date=O.START, end_date=O.END))
    add("filter_open_range", _on_tables(lambda t: enrich_maintenance(t, OPEN_RANGE)),
        O.maintenance_rows_sql())
    add("filter_all_combined", _on_tables(lambda t: enrich_sensors(t, COMBINED)),
        O.sensor_rows_sql(**O.COMBINED))
    add("filter_default_range",
        _on_tables(lambda t: enrich_maintenance(t, resolve_date_range(t, NONE))),
        O.default_range_sql())

    add("filter_default_range_narrow", _on_tables(_narrow_default_range), O.default_range_narrow_sql())
    for name, f, values in (("production_line", LINE, {"production_line": O.LINE}),
                            ("model", MODEL, {"model": O.MODEL})):
        add(f"filter_{name}_maintenance", _on_tables(lambda t, f=f: enrich_maintenance(t, f)),
            O.maintenance_rows_sql(**values))
        add(f"machine_master_{name}", _on_tables(lambda t, f=f: machine_master(t, f)),
            O.machine_master_sql(**values))

    # KPIs and bounds
    add("kpis", _on_tables(kpis), O.kpis_sql())
    add("kpis_empty", _on_tables(lambda t: kpis(t, NOWHERE)), O.kpis_sql(factory="NOWHERE"))
    add("kpis_scoped", _on_tables(lambda t: kpis(t, SCOPED)), O.kpis_sql(**O.SCOPED))
    add("kpis_combined", _on_tables(lambda t: kpis(t, COMBINED)), O.kpis_sql(**O.COMBINED))
    add("kpis_machine", _on_tables(lambda t: kpis(t, MACHINE)),
        O.kpis_sql(machine_id=O.MACHINE))
    add("date_bounds", _on_tables(date_bounds), O.date_bounds_sql())

    # chart tables, unfiltered and under a typical filtered view
    charts = {
        "daily_trend": daily_trend,
        "machine_performance": machine_performance,
        "alerts_by_machine": alerts_by_machine,
        "status_distribution": status_distribution,
        "maintenance_by_type": maintenance_by_type,
        "downtime_by_factory": downtime_by_factory,
    }
    for name, op in charts.items():
        add(name, _on_tables(op), O.chart_sql(name))
        add(f"{name}_scoped", _on_tables(lambda t, op=op: op(t, SCOPED)),
            O.chart_sql(name, **O.SCOPED))
    add("status_distribution_status",
        _on_tables(lambda t: status_distribution(t, STATUS)),
        O.chart_sql("status_distribution", status=O.STATUS))
    add("alerts_by_machine_model", _on_tables(lambda t: alerts_by_machine(t, MODEL)),
        O.chart_sql("alerts_by_machine", model=O.MODEL))

    # plotted series
    for key, (chart, x, y) in {
        "series_daily_temperature": ("daily_trend", "date", "average_temperature"),
        "series_daily_vibration": ("daily_trend", "date", "average_vibration"),
        "series_daily_energy": ("daily_trend", "date", "total_energy"),
        "series_machine_temperature": ("machine_performance", "machine_id", "average_temperature"),
        "series_machine_vibration": ("machine_performance", "machine_id", "average_vibration"),
        "series_cost_by_type": ("maintenance_by_type", "maintenance_type", "maintenance_cost"),
        "series_downtime_by_factory": ("downtime_by_factory", "factory", "downtime_minutes"),
    }.items():
        name = key.removeprefix("series_")
        add(key, _on_tables(lambda t, name=name: series(t, name)),
            O.series_sql(chart, f'"{x}"', y))

    # machine health
    add("machine_health", _on_tables(machine_health), O.machine_health_sql())
    add("machine_health_scoped", _on_tables(lambda t: machine_health(t, SCOPED)),
        O.machine_health_sql(**O.SCOPED))
    add("health_ignores_status", _on_tables(lambda t: machine_health(t, STATUS)),
        O.machine_health_sql(status=O.STATUS))
    add("health_status_counts", _on_tables(lambda t: health_status_counts(machine_health(t))),
        O.health_status_counts_sql())
    add("health_distribution", _on_tables(lambda t: health_distribution(machine_health(t))),
        O.health_distribution_sql())
    add("top_risk_machines", _on_tables(lambda t: top_risk_machines(machine_health(t))),
        O.top_risk_sql())
    add("top_risk_machines_scoped",
        _on_tables(lambda t: top_risk_machines(machine_health(t, SCOPED))),
        O.top_risk_sql(**O.SCOPED))

    # options and previews
    add("machine_metadata", _on_tables(machine_metadata),
        O.with_tables("\nSELECT DISTINCT machine_id, factory, production_line, model FROM machines"))
    add("options_factory", _on_tables(lambda t: option_values(t, "factory")),
        O.options_sql("factory"))
    add("options_production_line",
        _on_tables(lambda t: option_values(t, "production_line", FACTORY)),
        O.options_sql("production_line", factory=O.FACTORY))
    add("options_model",
        _on_tables(lambda t: option_values(
            t, "model", Filters(factory=O.FACTORY, production_line=O.LINE))),
        O.options_sql("model", factory=O.FACTORY, production_line=O.LINE))
    add("options_machine",
        _on_tables(lambda t: option_values(
            t, "machine_id",
            Filters(factory=O.FACTORY, production_line=O.LINE, model=O.MODEL))),
        O.options_sql("machine_id", factory=O.FACTORY, production_line=O.LINE, model=O.MODEL))
    add("latest_readings", _on_tables(latest_readings), O.latest_readings_sql())
    add("maintenance_history", _on_tables(maintenance_history), O.maintenance_history_sql())
    add("machine_master", _on_tables(machine_master), O.machine_master_sql())
    add("machine_master_factory", _on_tables(lambda t: machine_master(t, FACTORY)),
        O.machine_master_sql(factory=O.FACTORY))

    # data quality: machine ids repeated in the dimension (they repeat facts)
    add("duplicate_machines", _on_tables(lambda t: duplicate_machines(t.machines)),
        O.with_tables("""
SELECT machine_id, count(*) AS copies FROM machines
GROUP BY machine_id HAVING count(*) > 1"""))

    add("reject_counts", lambda spark, sf_dir: rejects(bind(spark, sf_dir)), O.reject_counts_sql())
    add("kpis_repeated_machines", _on_tables(lambda t: kpis(_repeated(t))),
        O.with_repeated_machines(O.kpis_sql()))
    add("machine_health_repeated_machines", _on_tables(lambda t: machine_health(_repeated(t))),
        O.with_repeated_machines(O.machine_health_sql()))

    # the loader over CSV files, prepared
    add("load_prepare_sensors", _loaded(lambda t: prepare(t)[0].drop(S.READING_ID)),
        O.sensor_rows_sql().replace("SELECT * FROM sensor_enriched",
                                    "SELECT * EXCLUDE (reading_id) FROM sensor_enriched"))

    # results over the curated layer, read again from its files
    for name, op, sql in (
        ("kpis", kpis, O.kpis_sql()),
        ("machine_health", machine_health, O.machine_health_sql()),
        ("daily_trend", daily_trend, O.chart_sql("daily_trend")),
        ("downtime_by_factory", downtime_by_factory, O.chart_sql("downtime_by_factory")),
        ("latest_readings", latest_readings, O.latest_readings_sql()),
    ):
        add(f"curated_{name}", _curated(op), sql)

    # streaming ingest, then the dashboard over the streamed layer
    add("stream_ingest_readings", _streamed(lambda t: t.sensors),
        O.with_tables("\nSELECT * FROM sensors"))
    add("stream_ingest_kpis", _streamed(kpis), O.kpis_sql())
    add("stream_ingest_health", _streamed(machine_health), O.machine_health_sql())

    # streamed readings folded into the curated layer
    add("compacted_readings", _compacted(lambda t: t.sensors), O.with_tables("\nSELECT * FROM sensors"))
    add("compacted_latest_readings", _compacted(latest_readings), O.latest_readings_sql())
    add("compacted_health", _compacted(machine_health), O.machine_health_sql())

    # the full refresh job: writes every result, returns (result, rows)
    add("refresh_manifest",
        lambda spark, sf_dir: refresh(spark, tables(spark, sf_dir), NONE,
                                      fresh_dir(spark, "refresh")),
        O.refresh_manifest_sql())
    # publications: whole refreshes, the newest and one that a reader holds
    add("published_kpis", _published(_newest_kpis), O.default_range_kpis_sql(factory=O.FACTORY))
    add("published_health_pinned", _published(_pinned_health), O.machine_health_sql(**O.SCOPED))

    # corrections by day
    add("corrected_kpis", _corrected(kpis), O.kpis_sql())
    add("corrected_health", _corrected(machine_health), O.machine_health_sql())

    # bucketed versions: joins without an exchange, one bucket for one machine
    add("bucketed_enrich_sensors", _bucketed(enrich_sensors), O.sensor_rows_sql())
    add("bucketed_enrich_maintenance", _bucketed(enrich_maintenance), O.maintenance_rows_sql())
    add("bucketed_filter_machine", _bucketed(lambda t: enrich_sensors(t, MACHINE)),
        O.sensor_rows_sql(machine_id=O.MACHINE))

    # load with quarantine
    add("quarantine_sensors", _judged(lambda spark, root: _listed(quarantine(spark, root, "sensors"))),
        O.quarantine_sensors_sql())
    add("quarantine_counts", _judged(load_counts), O.quarantine_counts_sql())
    add("quarantine_health",
        _judged(lambda spark, root: machine_health(parquet.read_tables(spark, root, with_aggregates=True))),
        O.without_unreadable(O.machine_health_sql()))
    return e


ENTRIES = _entries()


def spark_queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in ENTRIES.items()}


def oracle_queries() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql is not None}
