"""Write the mapped tables as Parquet, laid out as the jobs expect to find them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.inputs import TABLES, table
from memberlytics.sources.tables import read_table

EVENT_LOG = "customer_event_logs_raw"
SOURCES = [name for name in TABLES if name != "event_log" and not name.endswith("_mixed")]


def stage(spark: SparkSession, sf_dir: str, root: str) -> None:
    for name in SOURCES:
        table(spark, sf_dir, name).write.parquet(f"{root}/{name}")
    # By range, so that a busy day is written by several tasks and a task writes few days.
    log = table(spark, sf_dir, "event_log").repartitionByRange("dt", "timestamp")
    log.write.partitionBy("dt").parquet(f"{root}/{EVENT_LOG}")


def staged(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in SOURCES}
