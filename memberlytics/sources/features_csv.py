"""CSV interchange of the event feature table: header row, fixed column order, quoted JSON columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberlytics.schemas import SCHEMAS

FEATURES = SCHEMAS["user_event_features_7d"]


def write_features_csv(features: DataFrame, path: str) -> None:
    # The JSON columns hold quotes: doubling them is what other CSV readers expect.
    features.select(FEATURES.names).write.option("header", True).option("escape", '"').csv(path)


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed read; a header that differs from the fixed columns is an error, as is a malformed row."""
    reader = spark.read.schema(FEATURES).option("header", True).option("escape", '"')
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
