"""DuckDB oracle: the same queries as plain SQL over the test tables.

The SQL repeats the binding of the test tables (FIXTURES.md, section 2)
and the clean step as CTEs, and then states each query in the simplest
form: join the row-level facts with the dimension, filter, aggregate. The
Spark operators reach the same rows by other plans (partial aggregates
before the join, top-k before the join), so this is an independent check.

Conventions that keep both engines bit-identical: ``e0`` on decimal
literals (double, not DECIMAL), integer sums cast to BIGINT (DuckDB sums
integers to HUGEINT), NULL ordering spelled out where a LIMIT depends on it.
"""

from __future__ import annotations

# --- binding and clean step ------------------------------------------------

_SENSORS = """
sensors_raw AS (
  SELECT CAST(ts AS TIMESTAMP) AS "timestamp",
         'M' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS machine_id,
         CASE WHEN event_id % 97 = 5 THEN NULL
              WHEN event_id % 89 = 5 THEN CAST('NaN' AS DOUBLE)
              ELSE 60 + CAST(floor(value) AS BIGINT) / 8.0e0 END AS temperature_c,
         4 + (event_id % 64) / 32.0e0 AS pressure_bar,
         1 + CAST(floor(value) AS BIGINT) / 64.0e0 AS vibration_mm_s,
         10 + (event_id % 40) / 4.0e0 AS energy_kwh,
         CASE WHEN event_id % 83 = 5 THEN NULL
              WHEN value >= 200 THEN 'CRITICAL'
              WHEN value >= 125 THEN 'WARNING'
              ELSE 'OK' END AS status,
         event_id AS reading_id
  FROM events
),
sensors AS (
  SELECT "timestamp", machine_id, temperature_c, pressure_bar, vibration_mm_s,
         energy_kwh, status, reading_id, CAST("timestamp" AS DATE) AS "date"
  FROM sensors_raw
  WHERE machine_id IS NOT NULL AND "timestamp" IS NOT NULL
    AND temperature_c IS NOT NULL AND NOT isnan(temperature_c)
    AND pressure_bar IS NOT NULL AND NOT isnan(pressure_bar)
    AND vibration_mm_s IS NOT NULL AND NOT isnan(vibration_mm_s)
    AND energy_kwh IS NOT NULL AND NOT isnan(energy_kwh)
)"""

_MACHINES = """
machines_raw AS (
  SELECT 'M' || lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS machine_id,
         r_name AS factory,
         n_name AS production_line,
         CASE WHEN c_custkey % 29 = 7 THEN NULL ELSE c_mktsegment END AS model,
         CAST(DATE '2018-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS install_date,
         CASE WHEN c_acctbal < 2000 THEN 'Low'
              WHEN c_acctbal < 6000 THEN 'Medium'
              ELSE 'High' END AS criticality,
         CAST(CASE c_custkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END
              AS INTEGER) AS maintenance_interval_days
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
machines AS (
  SELECT * FROM machines_raw
  WHERE machine_id IS NOT NULL AND factory IS NOT NULL
    AND production_line IS NOT NULL AND model IS NOT NULL
)"""

_MAINTENANCE = """
maintenance_raw AS (
  SELECT 'E' || lpad(CAST(o_orderkey AS VARCHAR), greatest(8, length(CAST(o_orderkey AS VARCHAR)))::INTEGER, '0') AS event_id,
         'M' || lpad(CAST(o_custkey AS VARCHAR), greatest(6, length(CAST(o_custkey AS VARCHAR)))::INTEGER, '0') AS machine_id,
         CAST(DATE '2024-01-01'
              + CAST(datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INTEGER)
              AS DATE) AS event_date,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Corrective'
              WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'Inspection'
              ELSE 'Preventive' END AS maintenance_type,
         CAST(10 + o_orderkey % 350 AS INTEGER) AS downtime_minutes,
         CASE WHEN o_orderkey % 101 = 5 THEN NULL
              ELSE CAST(floor(o_totalprice) AS BIGINT) / 128.0e0 END AS cost_eur,
         'T0' || CAST(1 + o_orderkey % 5 AS VARCHAR) AS technician_id,
         CASE WHEN o_orderstatus = 'F' THEN 'Bearing wear'
              WHEN o_orderstatus = 'O' THEN 'Lubrication'
              ELSE 'Routine inspection' END AS issue
  FROM orders
),
maintenance AS (
  SELECT * FROM maintenance_raw
  WHERE event_id IS NOT NULL AND machine_id IS NOT NULL AND event_date IS NOT NULL
    AND maintenance_type IS NOT NULL AND downtime_minutes IS NOT NULL
    AND cost_eur IS NOT NULL AND NOT isnan(cost_eur)
)"""

_ENRICHED = """
sensor_enriched AS (
  SELECT s.machine_id, s."timestamp", s.temperature_c, s.pressure_bar, s.vibration_mm_s,
         s.energy_kwh, s.status, s.reading_id, s."date",
         m.factory, m.production_line, m.model, m.install_date, m.criticality,
         m.maintenance_interval_days
  FROM sensors s LEFT JOIN machines m ON s.machine_id = m.machine_id
),
maintenance_enriched AS (
  SELECT e.machine_id, e.event_id, e.event_date, e.maintenance_type, e.downtime_minutes,
         e.cost_eur, e.technician_id, e.issue,
         m.factory, m.production_line, m.model, m.install_date, m.criticality,
         m.maintenance_interval_days
  FROM maintenance e LEFT JOIN machines m ON e.machine_id = m.machine_id
)"""

PREFIX = "WITH" + ",".join([_SENSORS, _MACHINES, _MAINTENANCE, _ENRICHED]) + "\n"


def with_tables(body: str) -> str:
    """``body`` with the bound, cleaned and enriched tables in scope."""
    return PREFIX + body


# --- filters ----------------------------------------------------------------

# Filter values used by the registered queries; each hits data at every
# scale factor when used alone.
FACTORY = "ASIA"
LINE = "NATION_2"
MODEL = "MACHINERY"
MACHINE = "M000001"
STATUS = "CRITICAL"
START, END = "2024-01-05", "2024-01-12"
COMBINED = dict(
    factory="AMERICA",
    production_line="NATION_11",
    model="MACHINERY",
    status="CRITICAL",
    start_date="2024-01-05",
    end_date="2024-01-25",
)
SCOPED = dict(factory=FACTORY, start_date=START, end_date=END)  # a typical view


def where_sensors(factory=None, production_line=None, model=None, machine_id=None,
                  status=None, start_date=None, end_date=None) -> str:
    """WHERE clause of the enriched sensor rows for a filter set."""
    preds = ["TRUE"]
    for col, value in (("factory", factory), ("production_line", production_line),
                       ("model", model), ("machine_id", machine_id), ("status", status)):
        if value is not None:
            preds.append(f"{col} = '{value}'")
    if start_date is not None and end_date is not None:
        preds.append(f"\"date\" BETWEEN DATE '{start_date}' AND DATE '{end_date}'")
    return " AND ".join(preds)


def where_maintenance(factory=None, production_line=None, model=None, machine_id=None,
                      status=None, start_date=None, end_date=None) -> str:
    """WHERE clause of the enriched maintenance rows (status does not apply)."""
    preds = ["TRUE"]
    for col, value in (("factory", factory), ("production_line", production_line),
                       ("model", model), ("machine_id", machine_id)):
        if value is not None:
            preds.append(f"{col} = '{value}'")
    if start_date is not None and end_date is not None:
        preds.append(f"event_date BETWEEN DATE '{start_date}' AND DATE '{end_date}'")
    return " AND ".join(preds)


# --- query bodies ---------------------------------------------------------------


def kpis_sql(**f) -> str:
    s, m = where_sensors(**f), where_maintenance(**f)
    return with_tables(f"""
, fs AS (SELECT * FROM sensor_enriched WHERE {s})
, fm AS (SELECT * FROM maintenance_enriched WHERE {m})
, k AS (
  SELECT (SELECT count(DISTINCT machine_id) FROM fs) AS total_machines,
         (SELECT count(*) FROM fs) AS total_readings,
         (SELECT count(*) FROM fs WHERE status = 'WARNING') AS warning_events,
         (SELECT count(*) FROM fs WHERE status = 'CRITICAL') AS critical_events,
         (SELECT avg(temperature_c) FROM fs) AS average_temperature,
         (SELECT avg(vibration_mm_s) FROM fs) AS average_vibration,
         (SELECT COALESCE(CAST(sum(downtime_minutes) AS BIGINT), 0) FROM fm) AS total_downtime,
         (SELECT COALESCE(sum(cost_eur), 0.0e0) FROM fm) AS total_maintenance_cost
)
SELECT *,
       CASE WHEN total_readings > 0
            THEN (warning_events + critical_events) / total_readings * 100
            ELSE 0.0e0 END AS alert_rate,
       total_downtime / 60 AS downtime_hours
FROM k""")


def daily_trend_body(**f) -> str:
    return f"""
SELECT "date", avg(temperature_c) AS average_temperature,
       avg(vibration_mm_s) AS average_vibration, sum(energy_kwh) AS total_energy
FROM sensor_enriched WHERE {where_sensors(**f)}
GROUP BY "date" ORDER BY "date\""""


def machine_performance_body(**f) -> str:
    return f"""
SELECT machine_id, avg(temperature_c) AS average_temperature,
       avg(vibration_mm_s) AS average_vibration, avg(pressure_bar) AS average_pressure,
       count(*) AS number_of_readings
FROM sensor_enriched WHERE {where_sensors(**f)}
GROUP BY machine_id ORDER BY average_temperature DESC, machine_id"""


def alerts_body(**f) -> str:
    return f"""
SELECT machine_id,
       CAST(count(*) FILTER (WHERE status = 'WARNING') AS BIGINT) AS "WARNING",
       CAST(count(*) FILTER (WHERE status = 'CRITICAL') AS BIGINT) AS "CRITICAL"
FROM sensor_enriched
WHERE {where_sensors(**f)} AND status IN ('WARNING', 'CRITICAL')
GROUP BY machine_id ORDER BY "CRITICAL" DESC, "WARNING" DESC, machine_id"""


def status_distribution_body(**f) -> str:
    return f"""
SELECT status, count(*) AS "count"
FROM sensor_enriched WHERE {where_sensors(**f)}
GROUP BY status ORDER BY "count" DESC, status NULLS FIRST"""


def maintenance_by_type_body(**f) -> str:
    return f"""
SELECT maintenance_type, sum(cost_eur) AS maintenance_cost,
       CAST(sum(downtime_minutes) AS BIGINT) AS downtime_minutes,
       count(*) AS maintenance_events
FROM maintenance_enriched WHERE {where_maintenance(**f)}
GROUP BY maintenance_type ORDER BY maintenance_cost DESC, maintenance_type"""


def downtime_by_factory_body(**f) -> str:
    return f"""
SELECT factory, CAST(sum(downtime_minutes) AS BIGINT) AS downtime_minutes,
       sum(cost_eur) AS maintenance_cost
FROM maintenance_enriched WHERE {where_maintenance(**f)}
GROUP BY factory ORDER BY downtime_minutes DESC, factory NULLS FIRST"""


CHART_BODIES = {
    "daily_trend": daily_trend_body,
    "machine_performance": machine_performance_body,
    "alerts_by_machine": alerts_body,
    "status_distribution": status_distribution_body,
    "maintenance_by_type": maintenance_by_type_body,
    "downtime_by_factory": downtime_by_factory_body,
}


def chart_sql(name: str, **f) -> str:
    return with_tables(CHART_BODIES[name](**f))


def series_sql(chart: str, x: str, y: str, **f) -> str:
    """A two-column series of a chart table."""
    return with_tables(f"\n, chart AS ({CHART_BODIES[chart](**f)}\n)\nSELECT {x}, {y} FROM chart")


def _health_cte(**f) -> str:
    f = dict(f)
    f.pop("status", None)  # health ignores the status filter
    return f"""
, hb AS (
  SELECT machine_id, factory, production_line, model, criticality,
         count(*) AS readings,
         CAST(sum(CASE WHEN status = 'WARNING' THEN 1 ELSE 0 END) AS BIGINT) AS warnings,
         CAST(sum(CASE WHEN status = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT) AS criticals,
         avg(temperature_c) AS average_temperature,
         avg(vibration_mm_s) AS average_vibration,
         avg(pressure_bar) AS average_pressure
  FROM sensor_enriched WHERE {where_sensors(**f)}
  GROUP BY machine_id, factory, production_line, model, criticality
)
, hs AS (
  SELECT *, round((warnings + criticals) / readings * 100, 1) AS alert_rate_pct,
         round(greatest(0.0e0, 100.0e0 - (warnings + 3 * criticals) / readings * 100), 1)
           AS health_score
  FROM hb
)
, health AS (
  SELECT *, CASE WHEN health_score >= 90 THEN 'Healthy'
                 WHEN health_score >= 75 THEN 'Watch'
                 ELSE 'At Risk' END AS health_status
  FROM hs
)"""


def machine_health_sql(**f) -> str:
    return with_tables(_health_cte(**f) + "\nSELECT * FROM health ORDER BY health_score, machine_id")


def health_status_counts_sql(**f) -> str:
    return with_tables(_health_cte(**f) + """
SELECT count(*) FILTER (WHERE health_status = 'Healthy') AS healthy,
       count(*) FILTER (WHERE health_status = 'Watch') AS watch,
       count(*) FILTER (WHERE health_status = 'At Risk') AS at_risk
FROM health""")


def health_distribution_sql(**f) -> str:
    return with_tables(_health_cte(**f) + """
SELECT health_status, count(*) AS machines FROM health
GROUP BY health_status ORDER BY machines DESC, health_status""")


def top_risk_sql(**f) -> str:
    return with_tables(_health_cte(**f) + """
SELECT machine_id, factory, production_line, model, health_score, alert_rate_pct,
       warnings, criticals
FROM health ORDER BY health_score, machine_id LIMIT 5""")


def sensor_rows_sql(**f) -> str:
    return with_tables(f"\nSELECT * FROM sensor_enriched WHERE {where_sensors(**f)}")


def maintenance_rows_sql(**f) -> str:
    return with_tables(f"\nSELECT * FROM maintenance_enriched WHERE {where_maintenance(**f)}")


def options_sql(column: str, **earlier) -> str:
    preds = " AND ".join(["TRUE", *(f"{c} = '{v}'" for c, v in earlier.items())])
    return with_tables(f"""
SELECT DISTINCT {column} FROM machines
WHERE {preds} AND {column} IS NOT NULL ORDER BY {column}""")


def machine_master_sql(**f) -> str:
    preds = " AND ".join(["TRUE", *(f"{c} = '{v}'" for c, v in f.items())])
    return with_tables(f"\nSELECT * FROM machines WHERE {preds} ORDER BY machine_id")


def latest_readings_sql() -> str:
    return with_tables("""
SELECT * FROM sensor_enriched
ORDER BY "timestamp" DESC, machine_id, reading_id LIMIT 500""")


def maintenance_history_sql() -> str:
    return with_tables("""
SELECT * FROM maintenance_enriched
ORDER BY event_date DESC, event_id LIMIT 500""")


def date_bounds_sql() -> str:
    return with_tables('\nSELECT min("date") AS min_date, max("date") AS max_date FROM sensors')


def default_range_sql() -> str:
    return with_tables("""
SELECT * FROM maintenance_enriched
WHERE event_date BETWEEN (SELECT min("date") FROM sensors)
                     AND (SELECT max("date") FROM sensors)""")


def default_range_narrow_sql() -> str:
    return with_tables(f"""
SELECT * FROM maintenance_enriched
WHERE event_date BETWEEN (SELECT min("date") FROM sensors WHERE "date" BETWEEN DATE '{START}' AND DATE '{END}')
                     AND (SELECT max("date") FROM sensors WHERE "date" BETWEEN DATE '{START}' AND DATE '{END}')""")


def with_repeated_machines(sql: str) -> str:
    """``sql`` with the machines whose id ends in 5 twice in the dimension."""
    twice = _MACHINES.replace("\nmachines AS (", "\nmachines_once AS (") + """,
machines AS (
  SELECT * FROM machines_once
  UNION ALL SELECT * FROM machines_once WHERE machine_id LIKE '%5'
)"""
    return sql.replace(_MACHINES, twice)


def default_range_kpis_sql(**f) -> str:
    """KPIs of a view without a date range: events in that of the readings."""
    events = f"{where_maintenance(**f)} AND event_date BETWEEN (SELECT min(\"date\") FROM sensors) AND (SELECT max(\"date\") FROM sensors)"
    return kpis_sql(**f).replace(
        f", fm AS (SELECT * FROM maintenance_enriched WHERE {where_maintenance(**f)})",
        f", fm AS (SELECT * FROM maintenance_enriched WHERE {events})",
    )


# Cells that the dirty CSV files hold instead of readings, where reading_id
# modulo the divisor is 5.
NEVER_EACH, NEVER = 73, "2024-13-45 99:00:00"
NO_ENERGY_EACH, NO_ENERGY = 71, "n/a"


def without_unreadable(sql: str) -> str:
    """``sql`` over the dirty CSV files: their unreadable readings are gone."""
    return sql.replace(
        "FROM sensors_raw\n  WHERE machine_id",
        f"FROM sensors_raw\n  WHERE reading_id % {NEVER_EACH} <> 5 AND reading_id % {NO_ENERGY_EACH} <> 5 AND machine_id",
    )


def quarantine_sensors_sql() -> str:
    return with_tables(f"""
SELECT reading_id, machine_id, status, defects FROM (
  SELECT *, concat_ws('; ',
    CASE WHEN reading_id % {NEVER_EACH} = 5 THEN 'timestamp unreadable {NEVER}' END,
    CASE WHEN temperature_c IS NULL THEN 'temperature_c missing'
         WHEN isnan(temperature_c) THEN 'temperature_c not a number NaN' END,
    CASE WHEN reading_id % {NO_ENERGY_EACH} = 5 THEN 'energy_kwh unreadable {NO_ENERGY}' END) AS defects
  FROM sensors_raw)
WHERE defects <> ''""")


def quarantine_counts_sql() -> str:
    """Rows, accepted rows and rows per column and problem of a load of the
    dirty CSV files."""
    never, no_energy = f"reading_id % {NEVER_EACH} = 5", f"reading_id % {NO_ENERGY_EACH} = 5"
    kinds = ("missing", "unreadable", "not a number")
    found = {
        "sensors": {
            "timestamp: unreadable": never, "energy_kwh: unreadable": no_energy,
            "temperature_c: missing": "temperature_c IS NULL", "temperature_c: not a number": "isnan(temperature_c)",
        },
        "machines": {"model: missing": "model IS NULL"},
        "maintenance": {"cost_eur: missing": "cost_eur IS NULL"},
    }
    required = {
        "sensors": ("timestamp", "machine_id", "temperature_c", "pressure_bar", "vibration_mm_s", "energy_kwh"),
        "machines": ("machine_id", "factory", "production_line", "model"),
        "maintenance": ("event_id", "machine_id", "event_date", "maintenance_type", "downtime_minutes", "cost_eur"),
    }
    optional = {
        "sensors": ("status", "reading_id"),
        "machines": ("install_date", "criticality", "maintenance_interval_days"),
        "maintenance": ("technician_id", "issue"),
    }
    parts = []
    for table, columns in required.items():
        tests = {f"{c}: {kind}": "false" for c in columns for kind in kinds}
        tests |= {f"{c}: unreadable": "false" for c in optional[table]} | {"row: cells": "false"} | found[table]
        tests |= {"rows": "true", "accepted": "NOT coalesce(" + " OR ".join(found[table].values()) + ", false)"}
        parts += [
            f"SELECT '{table}' AS \"table\", '{reason}' AS reason, count(*) FILTER (WHERE {test}) AS \"rows\" FROM {table}_raw"
            for reason, test in tests.items()
        ]
    return with_tables("\n" + "\nUNION ALL ".join(parts))


def reject_counts_sql() -> str:
    def missing(column: str, number: bool) -> str:
        return f"({column} IS NULL" + (f" OR isnan({column}))" if number else ")")

    parts = []
    for table, columns in {
        "sensors": {"machine_id": 0, '"timestamp"': 0, "temperature_c": 1, "pressure_bar": 1,
                    "vibration_mm_s": 1, "energy_kwh": 1},
        "machines": {"machine_id": 0, "factory": 0, "production_line": 0, "model": 0},
        "maintenance": {"event_id": 0, "machine_id": 0, "event_date": 0, "maintenance_type": 0,
                        "downtime_minutes": 0, "cost_eur": 1},
    }.items():
        tests = {c.strip('"'): missing(c, bool(n)) for c, n in columns.items()}
        tests["any"] = "(" + " OR ".join(tests.values()) + ")"
        parts += [
            f"SELECT '{table}' AS \"table\", '{reason}' AS reason, count(*) FILTER (WHERE {test}) AS \"rows\""
            f" FROM {table}_raw" for reason, test in tests.items()
        ]
    return with_tables("\n" + "\nUNION ALL ".join(parts))


def refresh_manifest_sql() -> str:
    """Rows of every result of an unfiltered refresh (default date range =
    the sensor bounds, which also applies to maintenance events)."""
    counts = [
        ("date_bounds", "1", None),
        ("machine_health", "count(*)", "health"),
        ("health_status_counts", "1", None),
        ("health_distribution", "count(DISTINCT health_status)", "health"),
        ("top_risk_machines", "least(count(*), 5)", "health"),
        ("options_factory", "count(DISTINCT factory)", "machines"),
        ("options_production_line", "count(DISTINCT production_line)", "machines"),
        ("options_model", "count(DISTINCT model)", "machines"),
        ("options_machine", "count(DISTINCT machine_id)", "machines"),
        ("kpis", "1", None),
        ("latest_readings", "least(count(*), 500)", "se"),
        ("maintenance_history", "least(count(*), 500)", "me"),
        ("machine_master", "count(*)", "machines"),
        ("daily_trend", 'count(DISTINCT "date")', "se"),
        ("machine_performance", "count(DISTINCT machine_id)", "se"),
        ("alerts", "count(DISTINCT machine_id) FILTER (WHERE status IN ('WARNING', 'CRITICAL'))",
         "se"),
        ("status_distribution", "count(DISTINCT coalesce(status, ' null'))", "se"),
        ("maintenance_type", "count(DISTINCT maintenance_type)", "me"),
        ("factory_downtime", "count(DISTINCT coalesce(factory, ' null'))", "me"),
    ]
    selects = "\nUNION ALL ".join(
        f"SELECT '{name}' AS result, CAST({expr} AS BIGINT) AS rows"
        + (f" FROM {source}" if source else "")
        for name, expr, source in counts
    )
    return with_tables(_health_cte() + f"""
, b AS (SELECT min("date") AS lo, max("date") AS hi FROM sensors)
, se AS (SELECT * FROM sensor_enriched
         WHERE "date" BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b))
, me AS (SELECT * FROM maintenance_enriched
         WHERE event_date BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b))
{selects}""")
