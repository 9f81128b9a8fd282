"""Session settings and the shared scratch folder.

The library never creates or configures the caller's session; these
helpers are for scripts, tests and the bench.
"""

from __future__ import annotations

import atexit
import functools
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on or benefit from. Time zone: dates are
# derived from timestamps in the session zone.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark's call-site capture for error messages costs several JVM
    # round trips per DataFrame call on the driver; plans are unchanged.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "plantlens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a session in one process (``local[...]``) without one gets a
    temporary folder; on a cluster, also one of several processes on this
    machine, a local folder would be wrong, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _own_dir()
    return base


@functools.cache
def _own_dir() -> str:
    """This process's temporary folder, removed when it ends."""
    base = tempfile.mkdtemp(prefix="plantlens-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
