"""The six raw indices, T-scores, personas and the profile's usage and segment columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Index codes and the persona each one stands for.
PERSONA_BY_INDEX = {
    "explore": "SPACE_SHERLOCK",
    "benefit_trend": "SPACE_SURFER",
    "multi_device": "SPACE_OCTOPUS",
    "family_home": "SPACE_GRAVITY",
    "internet_security": "SPACE_GUARDIAN",
    "stability": "SPACE_EXPLORER",
}
DEFAULT_PERSONA = "SPACE_SHERLOCK"
INDEX_CODES = list(PERSONA_BY_INDEX)

# Points per membership grade; any other grade has none.
MEMBERSHIP_POINTS = {"VVIP": 100, "VIP": 80, "GOLD": 60, "BASIC": 40}

# Usage thresholds, upsell tags and upsell T-score limits.
OVER_RATIO = "1.0"
FIT_RATIO = "0.6"
UPSELL_TAGS = ["OTT프리미엄", "가족결합메인", "가족공유", "테더링쉐어링"]
UPSELL_TAG_COUNT = 2
UPSELL_TSCORES = {"benefit_trend": 55, "explore": 55, "multi_device": 60, "family_home": 60}
SEGMENTS = ["CHURN_RISK", "UPSELL", "NORMAL"]


def or_zero(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(0))


def damped(count: Column | str) -> Column:
    """ln(1 + count), a missing count being none."""
    return F.ln(F.lit(1) + or_zero(count))


def mapped(column: Column, values: dict, default) -> Column:
    result = None
    for key, value in values.items():
        result = (F if result is None else result).when(column == key, F.lit(value))
    return result.otherwise(F.lit(default))


def explore_raw() -> Column:
    return damped("click_product_detail_cnt") + 3 * damped("click_compare_cnt")


def benefit_trend_raw() -> Column:
    return damped("addon_subscribe_cnt") + damped("coupon_used_cnt") + damped("click_change_success_cnt")


def multi_device_raw() -> Column:
    limit = or_zero("sharing_limit_gb")
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), or_zero("sharing_used_gb") / limit))
    return or_zero("watch_flag") + or_zero("tablet_flag") + F.when(limit > 0, share).otherwise(F.lit(0.0))


def family_home_raw() -> Column:
    return damped("family_member_cnt") + or_zero("has_internet_iptv_bundle") + damped("children_count")


def internet_security_raw() -> Column:
    return F.lit(0.7) * or_zero("internet_flag") + F.lit(0.3) * damped("security_addon_cnt")


def stability_raw() -> Column:
    grade = mapped(F.col("membership"), MEMBERSHIP_POINTS, 0)
    satisfaction = or_zero("avg_monthly_satisfaction") / F.lit(5.0) * 100
    paid = F.when(F.coalesce(F.col("is_paid"), F.lit(False)), 100).otherwise(0)
    return (grade + satisfaction + paid) / F.lit(3.0)


RAW_SCORES = {
    "explore": explore_raw,
    "benefit_trend": benefit_trend_raw,
    "multi_device": multi_device_raw,
    "family_home": family_home_raw,
    "internet_security": internet_security_raw,
    "stability": stability_raw,
}


def t_score(value: Column, mean: Column, stddev: Column, lowest: Column, highest: Column) -> Column:
    """50 + 10 z. A column without spread scores 50 throughout.

    Spread is judged by the extremes: rounding in the running variance of doubles can leave a
    constant column with a tiny non-zero deviation.
    """
    return F.when(lowest.isNull() | (lowest == highest), F.lit(50.0)).otherwise(50 + 10 * ((value - mean) / stddev))


def persona_code(index_code: Column) -> Column:
    return mapped(index_code, PERSONA_BY_INDEX, DEFAULT_PERSONA)


def usage_percent(ratio: Column) -> Column:
    """The ratio in whole percent, halves rounded away from zero (exact on decimals)."""
    return F.round(ratio * 100).cast("int")


def usage_pattern(ratio: Column) -> Column:
    def above(limit: str) -> Column:
        return ratio > F.lit(limit).cast("decimal(2,1)")

    return (
        F.when(ratio.isNull(), F.lit(None).cast("string"))
        .when(above(OVER_RATIO), "OVER")
        .when(above(FIT_RATIO), "FIT")
        .otherwise("UNDER")
    )


def segment(churn_tier: Column, pattern: Column, upsell_tag_count: Column, tscores: dict[str, Column]) -> Column:
    upsell = (pattern == "OVER") | (upsell_tag_count >= UPSELL_TAG_COUNT)
    for code, limit in UPSELL_TSCORES.items():
        upsell = upsell | (or_zero(tscores[code]) >= limit)
    return F.when(churn_tier == "HIGH", "CHURN_RISK").when(upsell, "UPSELL").otherwise("NORMAL")
