"""Session settings the library is designed for, and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Broadcasts are never forced: Catalyst and AQE broadcast a side only when its
# measured size is below the threshold.  forceOptimizeSkewedJoin lets AQE split a
# hot join key even when that costs the plan one more shuffle further up.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# What one task is given, at most, in compressed bytes.  By default Spark deals an input to as many tasks as there are cores
# until these are several times as large, so that hash maps and sorts of one task would grow with the input.
SIZES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


def n_bytes(size: str) -> int:
    """The bytes that a size such as 64m, 64MB or 67108864b stands for."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built; its sizes of tasks are only made smaller."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    for name, value in SIZES.items():
        if n_bytes(spark.conf.get(name)) > n_bytes(value):
            spark.conf.set(name, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    A machine-local folder is used only in local mode, where nothing is shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        run = os.urandom(6).hex()
        return f"{root.rstrip('/')}/{name}-{run}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix=f"{name}-")
