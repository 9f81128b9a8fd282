"""Data-quality checks that explain surprising results.

A machine id that occurs more than once in the dimension repeats each of
its readings and events in every joined result (the join's semantics,
kept on purpose). This check lists such ids so that the data can be fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_machines(machines: DataFrame) -> DataFrame:
    """(machine_id, copies) for every id that occurs more than once."""
    return (
        machines.groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
