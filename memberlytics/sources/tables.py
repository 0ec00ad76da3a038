"""Source tables (Parquet folders, catalog tables or JDBC) and the start-up check that they exist."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from memberlytics.schemas import SCHEMAS


class MissingTables(RuntimeError):
    """A job was started without tables it needs."""


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table `root/name` under its fixed schema; unused columns are pruned at the scan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def read_jdbc_table(
    spark: SparkSession,
    name: str,
    options: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 64,
) -> DataFrame:
    """A table of a relational database, read by `splits` parallel range queries on `split_column`.

    Without `split_column` Spark reads the table through one connection, which suits dimensions only.
    """
    reader = spark.read.format("jdbc").options(dbtable=name, **options)
    if split_column:
        low, high = bounds
        reader = reader.options(
            partitionColumn=split_column, lowerBound=str(low), upperBound=str(high), numPartitions=str(splits)
        )
    return reader.load().select(SCHEMAS[name].names)


def table_exists(spark: SparkSession, name: str, root: str | None = None) -> bool:
    if root is None:
        return spark.catalog.tableExists(name)
    try:
        spark.read.schema("none int").parquet(f"{root}/{name}")
    except AnalysisException:
        return False
    return True


def require_tables(spark: SparkSession, names: Iterable[str], root: str | None = None, list_all: bool = False) -> None:
    """Raise `MissingTables` at the first missing table, or with the whole list if `list_all`."""
    missing = []
    for name in names:
        if not table_exists(spark, name, root):
            missing.append(name)
            if not list_all:
                break
    if missing:
        raise MissingTables("required tables are missing: " + ", ".join(missing))
