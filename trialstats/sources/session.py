"""Session settings that the plans of this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed values. Windows that ask for the first n rows of a group are cut before their shuffle for
# n up to the threshold. Adaptive execution sizes and splits shuffle partitions at run time; the
# session zone makes text times and zone-less timestamps mean the same everywhere.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
