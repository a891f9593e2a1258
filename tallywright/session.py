"""Session settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The skew settings let a hot merchant or store be split even where an aggregate follows the join on the same key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # recording the Python call site of every column expression takes longer than planning the report itself
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tallywright", **extra: str) -> SparkSession:
    """Get or create a session with the settings above; master and sizes come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
