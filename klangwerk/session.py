"""Session helpers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


#: So that Python workers, which live on between tasks, give freed arrays back.
MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(8 << 20), "MALLOC_ARENA_MAX": "2"}
#: Rows of a batch to Python, where the session has the default: texts can be long.
BATCH = 2_000


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies on a path they share with the driver, and bound their memory.

    On a cluster the package is installed on the executors or sent with --py-files.
    """
    env = spark.sparkContext.environment
    paths = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
    for name, value in MEMORY.items():
        if name not in env and name not in os.environ:
            env[name] = value
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return spark
