"""Data-quality checks: each is a one-row DataFrame; `require_*` raises on a bad one.

What a check counts is also there as columns (`*_counts`), so that a job can have it counted while it
writes a snapshot; `require_*` takes such counts as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlytics.functions.numbers import EXPONENT_FORM, PLAIN_NUMBER, json_number, json_text
from memberlytics.functions.scores import INDEX_CODES, SEGMENTS
from memberlytics.operators.lookups import join_lookup

TSCORE_COLUMNS = [f"{code}_tscore" for code in INDEX_CODES]
# Persona columns that must be filled.
PERSONA_COLUMNS = ["persona_type_id", "source_index_code", "source_tscore"]


class CheckFailed(RuntimeError):
    """Stored results do not pass a data-quality check."""


def _count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def _of_date(df: DataFrame, as_of: date) -> DataFrame:
    return df.where(F.col("snapshot_date") == F.lit(as_of))


def check_index_counts(member: DataFrame, raw: DataFrame, tscores: DataFrame, persona: DataFrame, as_of: date) -> DataFrame:
    """Row counts of the population and of the three snapshots of one date."""
    return member.select(F.count(F.lit(1)).alias("member_count")).select(
        "member_count",
        _count(_of_date(raw, as_of)).alias("raw_count"),
        _count(_of_date(tscores, as_of)).alias("tscore_count"),
        _count(_of_date(persona, as_of)).alias("persona_count"),
    )


def row_counts() -> dict[str, Column]:
    return {"row_count": F.count(F.lit(1))}


def null_counts(columns: Sequence[str]) -> dict[str, Column]:
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return {"null_count": F.count_if(missing)}


def context_counts() -> dict[str, Column]:
    segment = F.col("segment")
    return {
        "context_count": F.count(F.lit(1)),
        "null_pk_count": F.count_if(F.col("member_id").isNull()),
        "invalid_segment_count": F.count_if(segment.isNull() | ~segment.isin(SEGMENTS)),
        "null_product_types_count": F.count_if(F.col("current_product_types").isNull()),
    }


def _named(counts: Mapping[str, Column]) -> list[Column]:
    return [count.alias(name) for name, count in counts.items()]


def check_nulls(df: DataFrame, columns: Sequence[str], as_of: date) -> DataFrame:
    """Rows of one snapshot date with a null in any of `columns`."""
    return _of_date(df, as_of).agg(*_named(null_counts(columns)))


def check_not_empty(df: DataFrame, as_of: date) -> DataFrame:
    """Rows of one snapshot date."""
    return _of_date(df, as_of).agg(*_named(row_counts()))


def check_usage_amounts(usage_monthly: DataFrame, yyyymm: str) -> DataFrame:
    """Usage documents of a month: all, those whose amount is a number, and numbers too large to be kept as one."""
    rows = usage_monthly.where(F.col("yyyymm") == yyyymm).select("usage_details", json_text(F.col("usage_details"), "data_gb").alias("text"))
    amount = json_number(F.col("usage_details"), "data_gb", text=F.col("text"))
    number = F.col("text").rlike(PLAIN_NUMBER) | F.col("text").rlike(EXPONENT_FORM)
    return rows.select("text", amount.alias("amount")).agg(
        F.count(F.lit(1)).alias("document_count"),
        F.count("amount").alias("amount_count"),
        F.count_if(number & F.col("amount").isNull()).alias("too_large_count"),
    )


def eligible_count(subscription: DataFrame, product: DataFrame) -> DataFrame:
    """Members with any mobile plan subscription switched on."""
    plans = product.where(F.col("product_type") == "MOBILE_PLAN").select("product_id", F.lit(True).alias("is_plan"))
    # Few products hold most subscriptions. Which products are plans matters here, not their details.
    switched_on = subscription.where(F.col("status")).select("subscription_id", "member_id", "product_id")
    eligible = join_lookup(switched_on, plans.distinct(), "product_id", spread_by="subscription_id")
    return eligible.select(F.count_distinct("member_id").alias("eligible_count"))


def check_member_context(
    subscription: DataFrame, product: DataFrame, context: DataFrame, built: DataFrame | None = None
) -> DataFrame:
    """Members with any mobile plan subscription switched on against profile rows, and bad rows.

    The eligible members are counted without looking at dates or plan details, unlike the builder
    does, and profiles of former members stay in the table: a mismatch can be harmless. Pass the
    rows a run has built as `built` to have their number reported too.
    """
    eligible = eligible_count(subscription, product).scalar()
    check = context.agg(*_named(context_counts())).select(eligible.alias("eligible_count"), "*")
    return check if built is None else check.withColumn("built_count", _count(built))


def _counts(check: DataFrame | Mapping[str, int]) -> Mapping[str, int]:
    return check.first().asDict() if isinstance(check, DataFrame) else check


def require_index_counts(check: DataFrame | Mapping[str, int]) -> None:
    counts = _counts(check)
    if len(set(counts.values())) != 1:
        raise CheckFailed(f"snapshot row counts differ: {counts}")


def require_no_nulls(check: DataFrame | Mapping[str, int], what: str) -> None:
    nulls = _counts(check)["null_count"]
    if nulls:
        raise CheckFailed(f"{nulls} {what} rows have a null in a required column")


def require_not_empty(check: DataFrame | Mapping[str, int], what: str) -> None:
    if not _counts(check)["row_count"]:
        raise CheckFailed(f"the {what} snapshot is empty")


def require_member_context(check: DataFrame | Mapping[str, int]) -> None:
    row = _counts(check)
    if row["eligible_count"] != row["context_count"]:
        raise CheckFailed(f"{row['eligible_count']} eligible members but {row['context_count']} profiles: {row}")
    for name in ("null_pk_count", "invalid_segment_count", "null_product_types_count"):
        if row[name]:
            raise CheckFailed(f"{name} is {row[name]}")
