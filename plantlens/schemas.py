"""Table schemas, required columns and the fixed domain values.

Dates and timestamps are declared as strings for text sources and parsed
in the clean step, so one bad cell costs one row, not the type of the
whole column (schema inference would turn the column to string).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw text schemas (CSV) -------------------------------------------------

SENSOR_CSV = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("pressure_bar", T.DoubleType()),
        T.StructField("vibration_mm_s", T.DoubleType()),
        T.StructField("energy_kwh", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)

MACHINE_CSV = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("factory", T.StringType()),
        T.StructField("production_line", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("install_date", T.StringType()),
        T.StructField("criticality", T.StringType()),
        T.StructField("maintenance_interval_days", T.IntegerType()),
    ]
)

MAINTENANCE_CSV = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("maintenance_type", T.StringType()),
        T.StructField("downtime_minutes", T.DoubleType()),
        T.StructField("cost_eur", T.DoubleType()),
        T.StructField("technician_id", T.StringType()),
        T.StructField("issue", T.StringType()),
    ]
)

# Optional extra column of the sensor table: a unique reading id, used only
# as a tie-break for "latest readings". Text sources may omit it.
READING_ID = "reading_id"

# --- required columns (rows missing any of these are dropped) --------------

SENSOR_REQUIRED = (
    "machine_id",
    "timestamp",
    "temperature_c",
    "pressure_bar",
    "vibration_mm_s",
    "energy_kwh",
)
MACHINE_REQUIRED = ("machine_id", "factory", "production_line", "model")
MAINTENANCE_REQUIRED = (
    "event_id",
    "machine_id",
    "event_date",
    "maintenance_type",
    "downtime_minutes",
    "cost_eur",
)

# Machine attributes that the enriched fact tables carry.
MACHINE_ATTRIBUTES = (
    "factory",
    "production_line",
    "model",
    "install_date",
    "criticality",
    "maintenance_interval_days",
)

# Dimension columns a filter can select on (machine_id is the join key and
# is filtered on both sides).
DIMENSION_FILTER_COLUMNS = ("factory", "production_line", "model")

# --- fixed values (must match the source application) -----------------------

STATUS_OK = "OK"
STATUS_WARNING = "WARNING"
STATUS_CRITICAL = "CRITICAL"
STATUS_VALUES = (STATUS_OK, STATUS_WARNING, STATUS_CRITICAL)

# Sentinel of the filter widgets meaning "no filter".
ALL = "All"

# Health score: penalty 1 per warning and 3 per critical reading, in percent
# of readings; categories by the rounded score.
WARNING_PENALTY = 1
CRITICAL_PENALTY = 3
HEALTHY = "Healthy"
WATCH = "Watch"
AT_RISK = "At Risk"
HEALTHY_MIN_SCORE = 90
WATCH_MIN_SCORE = 75

# Preview sizes of the two "latest rows" tables and the top-risk list.
LATEST_ROWS = 500
TOP_RISK_ROWS = 5
