"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    # Splits the partition of a hot join key at run time and coalesces small ones.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tasks keep the first rows of a bounded report by themselves up to this limit; Spark's own is 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    "spark.sql.session.timeZone": "UTC",
    # A reload replaces the partitions of its own file only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "stagecheck", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
