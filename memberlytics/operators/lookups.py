"""Joins of many rows to one value per key, safe for a key that holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup is broadcast only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot from this share of all rows on, so there can be at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.001


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' in-memory size: 16 bytes per cell plus the text itself."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    per_row = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(16 * len(df.columns)))
    return df.agg(F.sum(per_row.cast("long"))).first()[0] or 0


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    *,
    spread_by: str,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join `rows` to `lookup` (unique on `key`): broadcast if it measures small, else hot keys apart."""
    if measured_bytes(lookup) <= max_bytes:
        return rows.join(F.broadcast(lookup), key, how)
    hot = lookup.join(F.broadcast(hot_keys(rows, key)), key, "left_semi")
    return join_hot_apart(rows, lookup, hot, key, spread_by, how)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that hold at least HOT_SHARE of all keyed rows; counted with map-side combining.

    The total is that of the counts, so that `rows` are gone through once for both.
    """
    per_key = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = per_key.select(F.sum("n")).scalar()
    return per_key.where(F.col("n") >= total * F.lit(HOT_SHARE)).select(key)


def join_hot_apart(
    rows: DataFrame, lookup: DataFrame, hot: DataFrame, key: str, spread_by: str, how: str = "left"
) -> DataFrame:
    """Join `rows` to `lookup` (unique on `key`) without sending a hot key's rows to one task.

    `hot` is the part of the lookup whose keys are hot: at most 1 / HOT_SHARE rows whatever the
    data, so it is broadcast. All other rows meet the lookup in a shuffled join. Rows already
    served, and rows without a key, pass through that join spread by `spread_by` under a flag
    nothing matches, so that they do not pile up in the null partition either. A key is in the lookup
    once, so its partitions are even: they are hashed, and the rows are not sorted.
    """
    values = [c for c in lookup.columns if c != key]
    hot = hot.select(key, F.struct(*values).alias("_hot"))
    rest = lookup.select(F.lit(True).alias("_open"), F.col(key).alias("_key"), F.struct(*values).alias("_rest"))

    served = rows.join(F.broadcast(hot), key, "left")
    is_open = F.col("_hot").isNull() & F.col(key).isNotNull()
    # The stand-in keys lie in the range of int, so that they fit any type of whole numbers from there on.
    elsewhere: Column = F.hash(spread_by).cast(rows.schema[key].dataType)
    joined = (
        served.withColumn("_open", is_open)
        .withColumn("_key", F.when(is_open, F.col(key)).otherwise(elsewhere))
        .join(rest.hint("shuffle_hash"), ["_open", "_key"], "left")
        .withColumn("_value", F.coalesce("_hot", "_rest"))
    )
    if how == "inner":
        joined = joined.where(F.col("_value").isNotNull())
    return joined.select(*rows.columns, *[F.col("_value")[c].alias(c) for c in values])
