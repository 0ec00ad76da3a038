"""The member calculations as SQL functions, for users who write SQL.

`register` makes them temporary functions of a session; Spark inlines their bodies, so a query with them has the
plan of the column expressions. `active_subscriptions` is a table function over the relations `subscription` and
`product`, which may be views or catalog tables. Limits, grades and tags are those of the column expressions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from memberlytics.functions.dates import AGE_GROUP_SUFFIX
from memberlytics.functions.numbers import EXPONENT_FORM, GB_TYPE, GIGABYTES, PLAIN_NUMBER
from memberlytics.functions.scores import (
    DEFAULT_PERSONA,
    FIT_RATIO,
    MEMBERSHIP_POINTS,
    OVER_RATIO,
    PERSONA_BY_INDEX,
    UPSELL_TAG_COUNT,
    UPSELL_TAGS,
    UPSELL_TSCORES,
)


def _cases(column: str, values: dict, default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{key}' THEN {value}" for key, value in values.items()) + f" ELSE {default} END"


_GRADES = _cases("membership", MEMBERSHIP_POINTS, "0")
_PERSONAS = _cases("index_code", {code: f"'{persona}'" for code, persona in PERSONA_BY_INDEX.items()}, f"'{DEFAULT_PERSONA}'")
_TAGS = ", ".join(f"'{tag}'" for tag in UPSELL_TAGS)
_HIGH_SCORE = " OR ".join(f"coalesce({code}_tscore, 0) >= {limit}" for code, limit in UPSELL_TSCORES.items())
_SCORES = ", ".join(f"{code}_tscore DOUBLE" for code in UPSELL_TSCORES)

# Signature and body of each function; later ones use earlier ones.
FUNCTIONS = {
    "whole_months(start_day DATE, end_day DATE) RETURNS INT": """
        CASE WHEN start_day <= end_day
          THEN (year(end_day) - year(start_day)) * 12 + month(end_day) - month(start_day) - if(day(end_day) < day(start_day), 1, 0)
          ELSE -((year(start_day) - year(end_day)) * 12 + month(start_day) - month(end_day) - if(day(start_day) < day(end_day), 1, 0)) END""",
    "age_group(birth_date DATE, as_of DATE) RETURNS STRING": f"""
        concat_ws('', CAST(CAST(whole_months(birth_date, as_of) / 120 AS INT) * 10 AS STRING), '{AGE_GROUP_SUFFIX}')""",
    "damped(n DOUBLE) RETURNS DOUBLE": "ln(1 + coalesce(n, 0))",
    "explore_raw(detail_clicks BIGINT, compare_clicks BIGINT) RETURNS DOUBLE": "damped(detail_clicks) + 3 * damped(compare_clicks)",
    "benefit_trend_raw(addons BIGINT, coupons BIGINT, plan_changes BIGINT) RETURNS DOUBLE": """
        damped(addons) + damped(coupons) + damped(plan_changes)""",
    "multi_device_raw(watch_flag INT, tablet_flag INT, limit_gb DOUBLE, used_gb DOUBLE) RETURNS DOUBLE": """
        coalesce(watch_flag, 0) + coalesce(tablet_flag, 0)
          + CASE WHEN limit_gb > 0 THEN least(1.0D, greatest(0.0D, coalesce(used_gb, 0) / limit_gb)) ELSE 0.0D END""",
    "family_home_raw(family_members BIGINT, bundle INT, children BIGINT) RETURNS DOUBLE": """
        damped(family_members) + coalesce(bundle, 0) + damped(children)""",
    "internet_security_raw(internet_flag INT, security_addons BIGINT) RETURNS DOUBLE": """
        0.7D * coalesce(internet_flag, 0) + 0.3D * damped(security_addons)""",
    "stability_raw(membership STRING, satisfaction DOUBLE, is_paid BOOLEAN) RETURNS DOUBLE": f"""
        ({_GRADES} + coalesce(satisfaction, 0) / 5.0D * 100 + if(coalesce(is_paid, false), 100, 0)) / 3.0D""",
    "t_score(value DOUBLE, mean DOUBLE, deviation DOUBLE, lowest DOUBLE, highest DOUBLE) RETURNS DOUBLE": """
        CASE WHEN lowest IS NULL OR lowest = highest THEN 50.0D ELSE 50 + 10 * ((value - mean) / deviation) END""",
    "persona_code(index_code STRING) RETURNS STRING": _PERSONAS,
    "allowance_gb(amount STRING) RETURNS DECIMAL(23, 9)": f"""
        CASE WHEN amount RLIKE r'{GIGABYTES}' THEN try_cast(regexp_replace(amount, r'GB\\z', '') AS {GB_TYPE}) END""",
    "json_gb(document STRING, text STRING, number DOUBLE) RETURNS DECIMAL(23, 9)": f"""
        CASE WHEN text RLIKE r'{EXPONENT_FORM}' THEN try_cast(number AS {GB_TYPE})
          WHEN text RLIKE r'{PLAIN_NUMBER}' THEN try_cast(text AS {GB_TYPE}) END""",
    "used_gb(document STRING) RETURNS DECIMAL(23, 9)": """
        json_gb(document, from_json(document, 'data_gb string').data_gb, from_json(document, 'data_gb double').data_gb)""",
    "usage_share(allowance DECIMAL(23, 9), used DECIMAL(23, 9)) RETURNS DECIMAL(38, 15)": "CASE WHEN allowance <> 0 THEN used / allowance END",
    "usage_percent(share DECIMAL(38, 15)) RETURNS INT": "CAST(round(share * 100) AS INT)",
    "usage_pattern(share DECIMAL(38, 15)) RETURNS STRING": f"""
        CASE WHEN share IS NULL THEN NULL WHEN share > {OVER_RATIO}BD THEN 'OVER' WHEN share > {FIT_RATIO}BD THEN 'FIT' ELSE 'UNDER' END""",
    "upsell_tag_count(tags_json STRING) RETURNS INT": f"""
        coalesce(size(filter(from_json(tags_json, 'array<string>'), tag -> tag IN ({_TAGS}))), 0)""",
    f"segment_of(churn_tier STRING, pattern STRING, tag_count INT, {_SCORES}) RETURNS STRING": f"""
        CASE WHEN churn_tier = 'HIGH' THEN 'CHURN_RISK'
          WHEN coalesce(pattern = 'OVER', false) OR tag_count >= {UPSELL_TAG_COUNT} OR {_HIGH_SCORE} THEN 'UPSELL' ELSE 'NORMAL' END""",
    "ends_within_3_months(end_day DATE, as_of DATE) RETURNS BOOLEAN": "coalesce(end_day >= as_of AND end_day < add_months(as_of, 3), false)",
}
TABLE_FUNCTIONS = {
    """active_subscriptions(as_of DATE) RETURNS TABLE (subscription_id BIGINT, member_id BIGINT, product_id BIGINT, start_date DATE,
      end_date DATE, contract_end_date DATE, product_name STRING, product_type STRING)""": """
        SELECT s.subscription_id, s.member_id, s.product_id, s.start_date, s.end_date, s.contract_end_date, p.name, p.product_type
        FROM subscription s JOIN product p ON s.product_id = p.product_id
        WHERE s.status AND s.start_date <= as_of AND (s.end_date IS NULL OR s.end_date >= as_of)""",
}


def register(spark: SparkSession) -> None:
    """Make the scalar functions temporary functions of the session."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_tables(spark: SparkSession) -> None:
    """The table functions too; the relations they read must be there."""
    for signature, body in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
