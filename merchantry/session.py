"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys: the larger side of a skewed join partition is split at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches of long texts stay small in Python workers
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call sites for every column expression cost more than building the plan itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName("merchantry")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
