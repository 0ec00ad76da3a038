"""Set-based upserts: table in, table out. Writing the result is up to the caller.

None of them shuffles the current table when the incoming rows are few: the current table is
always the streamed side, so a small set of incoming rows can be broadcast by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """Rows that should be unique on their key are not."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    found = duplicate_keys(df, keys).first()
    if found:
        raise DuplicateKeys(f"{found['n']} rows share the key {found.asDict()}")


def checked_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df`, failing while it runs if two of its rows share a key."""
    repeats = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    message = F.concat(F.lit("DuplicateKeys: rows share the key "), F.to_json(F.struct(*keys)))
    guarded = df.withColumn("_repeats", F.when(repeats > 1, F.raise_error(message)).otherwise(F.lit(False)))
    return guarded.where(~F.col("_repeats")).drop("_repeats")


def checked_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`checked_unique` for wide rows that are stored: `df` is read once more, but only its keys are shuffled and counted."""
    repeated = duplicate_keys(df, keys).select(F.max(F.to_json(F.struct(*keys)))).scalar()
    wrong = F.raise_error(F.concat(F.lit("DuplicateKeys: rows share the key "), repeated))
    return df.where(F.when(repeated.isNull(), F.lit(True)).otherwise(wrong.cast("boolean")))


def upsert_by_key(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole-row upsert: incoming rows replace or extend, all other rows stay. Repeated incoming keys fail.

    `updates` is read for its keys and for its rows, so pass a stored table.
    """
    others = current.join(updates.select(*keys), list(keys), "left_anti")
    return others.unionByName(checked_by_keys(updates, keys))


def insert_ignore(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows of `new` whose key is not there yet; of new rows with one key, the smallest in column order."""
    new = new.select(*current.columns)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in current.columns]))
    first = new.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
    present = current.select(*keys).join(first.select(*keys), list(keys), "left_semi")
    return current.unionByName(first.join(present, list(keys), "left_anti"))


def upsert_columns(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    update_columns: Sequence[str],
    insert_defaults: dict[str, Column],
) -> DataFrame:
    """Partial upsert: on a match only `update_columns` change; an insert takes `insert_defaults`.

    A column of an inserted row comes from `updates`, else from `insert_defaults`, else is null.
    Repeated incoming keys fail.
    """
    updates = checked_unique(updates, [key])
    incoming = updates.select(
        key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in update_columns]
    )
    updated = current.join(incoming, key, "left").select(
        *[
            (F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in update_columns else F.col(c)).alias(c)
            for c in current.columns
        ]
    )

    present = current.select(key).join(updates.select(key), key, "left_semi")
    inserted = updates.join(present, key, "left_anti").select(
        *[
            (F.col(c) if c in updates.columns else insert_defaults.get(c, F.lit(None)))
            .cast(current.schema[c].dataType)
            .alias(c)
            for c in current.columns
        ]
    )
    return updated.unionByName(inserted)
