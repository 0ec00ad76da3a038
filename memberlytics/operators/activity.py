"""Coupons, counselling, billing and log features per member."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlytics.functions.dates import in_last_days, in_month
from memberlytics.operators.ranking import latest_by, top_per_key

# Window lengths in days, and how counselling titles are joined.
COUPON_DAYS = 7
LOG_DAYS = 15
COUNSELING_CASES = 3
COUNSELING_SEPARATOR = " | "


def coupon_7d(member_coupon: DataFrame, as_of: date) -> DataFrame:
    used = F.col("is_used") & in_last_days(F.col("used_at"), as_of, COUPON_DAYS)
    return member_coupon.where(used).groupBy("member_id").agg(F.count(F.lit(1)).alias("coupon_used_cnt"))


def support_monthly(support_case: DataFrame, yyyymm: str) -> DataFrame:
    """Mean satisfaction of the cases closed, or else last changed, in the month."""
    resolved, updated = F.col("resolved_at"), F.col("updated_at")
    closed = in_month(resolved, yyyymm) | (resolved.isNull() & in_month(updated, yyyymm))
    rated = support_case.where(F.col("satisfaction_score").isNotNull() & closed)
    return rated.groupBy("member_id").agg(F.avg("satisfaction_score").alias("avg_monthly_satisfaction"))


def billing_monthly(billing: DataFrame, yyyymm: str) -> DataFrame:
    """Paid status of the month, one row per bill: a second bill repeats the member."""
    return billing.where(F.col("yyyymm") == yyyymm).select("member_id", "is_paid")


def log_features(features: DataFrame, as_of: date) -> DataFrame:
    """Event features of exactly this snapshot date."""
    return features.where(F.col("snapshot_date") == F.lit(as_of)).select(
        "member_id", "click_product_detail_cnt", "click_compare_cnt", "click_change_success_cnt"
    )


def latest_logs(features: DataFrame, as_of: date, days: int = LOG_DAYS) -> DataFrame:
    """The newest event features among the last `days` calendar days (14 days back and today)."""
    recent = features.where(in_last_days(F.col("snapshot_date"), as_of, days))
    newest = latest_by(recent, "member_id", [F.col("snapshot_date").desc()])
    return newest.select("member_id", "product_type_clicks", "product_type_top_tags")


def recent_counseling(support_case: DataFrame, n: int = COUNSELING_CASES) -> DataFrame:
    """Titles of the newest `n` cases that have one, newest first."""
    titled = support_case.where(F.trim("title") != "").select("member_id", "title", "created_at", "case_id")
    newest_first = [F.col("created_at").desc_nulls_first(), F.col("case_id").desc()]
    titles = F.array_sort(F.collect_list(F.struct("rn", "title")))["title"]
    return (
        top_per_key(titled, ["member_id"], newest_first, n)
        .groupBy("member_id")
        .agg(F.array_join(titles, COUNSELING_SEPARATOR).alias("recent_counseling"))
    )


def latest_persona(persona: DataFrame, up_to: date | None = None) -> DataFrame:
    newest = latest_by(_bounded(persona, "snapshot_date", up_to), "member_id", [F.col("snapshot_date").desc_nulls_first()])
    return newest.select("member_id", "persona_code")


def latest_tscore(tscores: DataFrame, up_to: date | None = None) -> DataFrame:
    columns = ["explore_tscore", "benefit_trend_tscore", "multi_device_tscore", "family_home_tscore"]
    newest = latest_by(
        _bounded(tscores, "snapshot_date", up_to).select("snapshot_date", "member_id", *columns),
        "member_id",
        [F.col("snapshot_date").desc_nulls_first()],
    )
    return newest.drop("snapshot_date")


def latest_churn(churn: DataFrame, up_to: date | None = None) -> DataFrame:
    newest = latest_by(_bounded(churn, "base_date", up_to), "member_id", [F.col("base_date").desc_nulls_first()])
    return newest.select("member_id", "churn_score", F.col("risk_level").alias("churn_tier"))


def _bounded(df: DataFrame, column: str, up_to: date | None) -> DataFrame:
    """All rows by default, as a back-fill then sees later snapshots; `up_to` shuts those out."""
    return df if up_to is None else df.where(F.col(column) <= F.lit(up_to))
