"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness settings: epoch columns are read as UTC and a bad cast must fail, not turn into NULL.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Performance settings; what the cluster or the application has set stays.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parsing makes 64 MB of shuffled pages a long task: smaller ones leave no core waiting for the last of a stage.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required and advised runtime settings to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    chosen = spark.sparkContext.getConf()
    for key, value in ADVISED.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark
