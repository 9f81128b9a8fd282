"""Binding of the driver's test tables to the three input schemas.

The test data set has no plant telemetry, so each input table is a
deterministic projection of a test table (see FIXTURES.md, section 2):

* sensors     <- ``events``
* machines    <- ``customer`` joined with ``nation`` and ``region``
* maintenance <- ``orders``

The projections include dirt on purpose (NULL and NaN measures, machines
without a model, events without a cost) so that the clean step has work.
All measures are multiples of 1/128 or coarser, so sums are exact in any
order and the two engines of the correctness check agree bit for bit.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.tables import Tables

# Fixed values of the binding (FIXTURES.md, section 2).
INSTALL_EPOCH = dt.date(2018, 1, 1)
ORDER_EPOCH = dt.date(1995, 1, 1)
EVENT_EPOCH = dt.date(2024, 1, 1)
EVENT_DAYS = 30
CRITICAL_VALUE = 200
WARNING_VALUE = 125
LOW_BALANCE = 2000
MEDIUM_BALANCE = 6000
INTERVAL_DAYS = (30, 45, 60, 90)  # by c_custkey % 4 = 0, 1, 2, 3


def _padded(prefix: str, key: str, width: int) -> Column:
    text = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def machine_key(key: str) -> Column:
    """``M`` plus the key left-padded to 6 digits at least (never cut)."""
    return _padded("M", key, 6)


def bind_sensors(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    level = F.floor(F.col("value")).cast("bigint")
    temperature = (
        F.when(eid % 97 == 5, F.lit(None).cast("double"))
        .when(eid % 89 == 5, F.lit(float("nan")))
        .otherwise(60 + level / 8.0)
    )
    status = (
        F.when(eid % 83 == 5, F.lit(None).cast("string"))
        .when(F.col("value") >= CRITICAL_VALUE, F.lit(S.STATUS_CRITICAL))
        .when(F.col("value") >= WARNING_VALUE, F.lit(S.STATUS_WARNING))
        .otherwise(F.lit(S.STATUS_OK))
    )
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        machine_key("user_id").alias("machine_id"),
        temperature.alias("temperature_c"),
        (4 + (eid % 64) / 32.0).alias("pressure_bar"),
        (1 + level / 64.0).alias("vibration_mm_s"),
        (10 + (eid % 40) / 4.0).alias("energy_kwh"),
        status.alias("status"),
        eid.alias(S.READING_ID),
    )


def bind_machines(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    interval = F.when(key % 4 == 0, F.lit(INTERVAL_DAYS[0]))
    for rest, days in enumerate(INTERVAL_DAYS[1:-1], start=1):
        interval = interval.when(key % 4 == rest, F.lit(days))
    interval = interval.otherwise(F.lit(INTERVAL_DAYS[-1]))
    # nation and region are fixed-size code tables (25 and 5 rows); the
    # planner's size check broadcasts them.
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return located.select(
        machine_key("c_custkey").alias("machine_id"),
        F.col("r_name").alias("factory"),
        F.col("n_name").alias("production_line"),
        F.when(key % 29 == 7, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment"))
        .alias("model"),
        F.date_add(F.lit(INSTALL_EPOCH), (key % 2000).cast("int")).alias("install_date"),
        F.when(F.col("c_acctbal") < LOW_BALANCE, F.lit("Low"))
        .when(F.col("c_acctbal") < MEDIUM_BALANCE, F.lit("Medium"))
        .otherwise(F.lit("High"))
        .alias("criticality"),
        interval.cast("int").alias("maintenance_interval_days"),
    )


def bind_maintenance(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    priority = F.substring(F.col("o_orderpriority"), 1, 1)
    day = F.datediff(F.to_date(F.col("o_orderdate")), F.lit(ORDER_EPOCH)) % EVENT_DAYS
    return orders.select(
        _padded("E", "o_orderkey", 8).alias("event_id"),
        machine_key("o_custkey").alias("machine_id"),
        F.date_add(F.lit(EVENT_EPOCH), day).alias("event_date"),
        F.when(priority.isin("1", "2"), F.lit("Corrective"))
        .when(priority == "3", F.lit("Inspection"))
        .otherwise(F.lit("Preventive"))
        .alias("maintenance_type"),
        (10 + key % 350).cast("int").alias("downtime_minutes"),
        F.when(key % 101 == 5, F.lit(None).cast("double"))
        .otherwise(F.floor(F.col("o_totalprice")).cast("bigint") / 128.0)
        .alias("cost_eur"),
        F.concat(F.lit("T0"), (1 + key % 5).cast("string")).alias("technician_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Bearing wear"))
        .when(F.col("o_orderstatus") == "O", F.lit("Lubrication"))
        .otherwise(F.lit("Routine inspection"))
        .alias("issue"),
    )


def bind(spark: SparkSession, sf_dir: str) -> Tables:
    """The raw (uncleaned) three tables bound from ``sf_dir``'s Parquet files."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

    return Tables(
        sensors=bind_sensors(read("events")),
        machines=bind_machines(read("customer"), read("nation"), read("region")),
        maintenance=bind_maintenance(read("orders")),
    )
