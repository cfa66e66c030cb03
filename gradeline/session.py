"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings the operators are tuned for.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes of bytecode. The cleaning pass of a
    # wide table exceeds that as one fused method and would run interpreted; with the limit
    # Spark splits it into small methods instead. Narrow stages stay fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The checked table is partitioned by a handful of outcomes: one open file per outcome
    # saves sorting every task's rows before the write.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


# Settings to give the session builder.
BUILD_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Without it every column expression records its Python call site, at several round
    # trips to the JVM each; a wide projection is planned in less than half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; call once per session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
