"""Session settings the jobs are meant to run with. All are ordinary Spark settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Sizes are known only at run time: start with many partitions, merge the small ones, split
    # the skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A retried stage must not lose work to a lost executor's disk for want of attempts.
    "spark.stage.maxConsecutiveAttempts": "8",
    # Call sites of column expressions are of use to a debugger only, and cost a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
