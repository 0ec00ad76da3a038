"""The member population and its family groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlytics.operators.lookups import HOT_SHARE, join_hot_apart


def base_members(member: DataFrame) -> DataFrame:
    """Every member; an unknown number of children counts as none."""
    return member.select(
        "member_id",
        "membership",
        "birth_date",
        F.coalesce("children_count", F.lit(0)).alias("children_count"),
        "family_group_id",
        "family_role",
    )


def family_counts(member: DataFrame) -> DataFrame:
    """Members per family group, oneself included."""
    grouped = member.where(F.col("family_group_id").isNotNull()).groupBy("family_group_id")
    return grouped.agg(F.count(F.lit(1)).alias("family_member_cnt"))


def with_family_size(members: DataFrame, counts: DataFrame) -> DataFrame:
    """Attach `family_member_cnt`. The counts themselves tell which groups are hot."""
    total = counts.select(F.sum("family_member_cnt")).scalar()
    hot = counts.where(F.col("family_member_cnt") >= total * F.lit(HOT_SHARE))
    return join_hot_apart(members, counts, hot, "family_group_id", spread_by="member_id")
