"""First rows per key and in all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first `k` rows of every key with their rank in `rn`.

    The rank filter directly above the window lets Catalyst cut each task's rows to `k` per key
    before the shuffle (WindowGroupLimit), so a hot key costs the shuffle k rows per task.
    """
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rn") <= k)


def latest_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`."""
    keys = [keys] if isinstance(keys, str) else keys
    return top_per_key(df, keys, order, 1).drop("rn")


def order_limit(df: DataFrame, column: str, n: int) -> DataFrame:
    """The `n` rows with the lowest `column` (a distributed top-n, not a full sort)."""
    return df.orderBy(column).limit(n)


def ranked(df: DataFrame, column: str, rank: str, path: str) -> DataFrame:
    """`df` with the rank of its rows by `column`, counted from 0, stored at `path`.

    Rows are range-partitioned and numbered within their partition; the partitions' counts, a row
    each, give the offsets. No task sees more than its partition.
    """
    spark = df.sparkSession
    parts = df.repartitionByRange(column).withColumn("_part", F.spark_partition_id())
    parts.sortWithinPartitions(column).write.parquet(path)
    stored = spark.read.schema(parts.schema).parquet(path)
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    numbered = stored.withColumn("_within", within).join(offsets, "_part")
    return numbered.withColumn(rank, F.col("_offset") + F.col("_within")).drop("_part", "_within", "_offset")
