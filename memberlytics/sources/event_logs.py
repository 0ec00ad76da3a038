"""The raw event log, partitioned by arrival day `dt`."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.functions.dates import in_last_days
from memberlytics.schemas import SCHEMAS

# Fixed value: how many daily partitions, the snapshot date included, a feature run reads.
SCAN_DAYS = 90


def in_scan_window(events: DataFrame, as_of: date, days: int = SCAN_DAYS) -> DataFrame:
    """Restrict by arrival day; on a partitioned log this prunes the file listing."""
    return events.where(in_last_days(F.col("dt").cast("date"), as_of, days))


def scan_event_logs(spark: SparkSession, path: str, as_of: date, days: int = SCAN_DAYS) -> DataFrame:
    log = spark.read.schema(SCHEMAS["customer_event_logs_raw"]).parquet(path)
    return in_scan_window(log, as_of, days)


def scan_event_days(spark: SparkSession, path: str, days: Iterable[date]) -> DataFrame:
    """Only the partitions of some arrival days."""
    log = spark.read.schema(SCHEMAS["customer_event_logs_raw"]).parquet(path)
    return log.where(F.col("dt").cast("date").isin(list(days)))


def day_signs(spark: SparkSession, path: str, as_of: date, days: int = SCAN_DAYS) -> dict[date, str]:
    """A sign of the files (path, size, time) of every arrival day of the window that has any, by listing alone.

    It changes when files of a day come, go or are rewritten. A row per day reaches the driver.
    """
    # The reader opens files only for their `content`, which nothing here asks for.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    sign = F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.hex(F.bit_xor(F.xxhash64("path", "length", "modificationTime"))))
    listed = in_scan_window(files, as_of, days).groupBy(F.col("dt").cast("date").alias("day")).agg(sign.alias("sign"))
    return {row["day"]: row["sign"] for row in listed.collect()}
