"""plantlens: plant telemetry and machine-health analytics on Spark.

Three input tables (sensor readings, machine dimension, maintenance
events) are cleaned, enriched with the machine attributes, filtered and
aggregated into KPIs, chart tables and a machine-health score. Every
operator takes and returns DataFrames; nothing is collected to the driver.
"""

from plantlens.operators import *  # noqa: F401,F403
from plantlens.operators import __all__ as _ops
from plantlens.tables import Tables

__all__ = ["Tables", *_ops]
