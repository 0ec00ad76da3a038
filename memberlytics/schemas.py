"""Explicit schemas of every table the jobs read or write. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from memberlytics.functions.scores import INDEX_CODES

# Columns counting clicks, in interchange order.
CLICK_COLUMNS = [
    "click_list_type_cnt",
    "click_product_detail_cnt",
    "click_compare_cnt",
    "click_coupon_cnt",
    "click_penalty_cnt",
    "click_change_cnt",
    "click_change_success_cnt",
]


EVENT_PROPERTIES = T.StructType().add("product_type", T.StringType()).add("tags", T.ArrayType(T.StringType()))

TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "event_properties": EVENT_PROPERTIES,
}


def schema(columns: str) -> T.StructType:
    """A schema from "name type, ..."; unlike the DDL parser this needs no session at import."""
    fields = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


def _index(suffix: str) -> str:
    return ", ".join(f"{code}_{suffix} double" for code in INDEX_CODES)


SCHEMAS = {
    "member": schema(
        "member_id bigint, membership string, birth_date date, children_count int, "
        "family_group_id bigint, family_role string"
    ),
    "product": schema("product_id bigint, name string, product_type string"),
    "subscription": schema(
        "subscription_id bigint, member_id bigint, product_id bigint, status boolean, "
        "start_date date, end_date date, contract_end_date date"
    ),
    "addon_service": schema("product_id bigint, addon_type string"),
    "mobile_plan": schema("product_id bigint, data_amount string, tethering_sharing_data string"),
    "usage_monthly": schema("subscription_id bigint, yyyymm string, usage_details string"),
    "member_coupon": schema("coupon_id bigint, member_id bigint, is_used boolean, used_at timestamp_ntz"),
    "support_case": schema(
        "case_id bigint, member_id bigint, title string, satisfaction_score int, "
        "created_at timestamp_ntz, resolved_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "billing": schema("member_id bigint, yyyymm string, is_paid boolean"),
    "persona_type": schema("persona_type_id bigint, character_name string, version int, is_active boolean"),
    "churn_score_snapshot": schema("member_id bigint, base_date date, churn_score int, risk_level string"),
    "customer_event_logs_raw": schema(
        "member_id bigint, event_name string, timestamp string, "
        "event_properties event_properties, dt string"
    ),
    "user_event_features_7d": schema(
        "snapshot_date date, member_id bigint, "
        + ", ".join(f"{c} bigint" for c in CLICK_COLUMNS)
        + ", product_type_clicks string, product_type_top_tags string"
    ),
    "event_daily_partials": schema(
        "snapshot_date date, member_id bigint, event_date date, event_name string, kind int, value string, n bigint"
    ),
    "index_raw_snapshot": schema(f"snapshot_date date, member_id bigint, {_index('raw')}"),
    "index_tscore_snapshot": schema(f"snapshot_date date, member_id bigint, {_index('tscore')}"),
    "index_persona_snapshot": schema(
        "snapshot_date date, member_id bigint, persona_type_id bigint, persona_code string, "
        "source_index_code string, source_tscore double"
    ),
    "member_context": schema(
        "member_id bigint, membership string, age_group string, join_months int, children_count int, "
        "family_group_num int, family_role string, persona_code string, segment string, "
        "current_subscriptions string, current_product_types string, current_data_usage_ratio int, "
        "data_usage_pattern string, churn_score int, churn_tier string, recent_counseling string, "
        "product_type_clicks string, recent_viewed_tags_top_3 string, contract_expiry_within_3m boolean, "
        "updated_at timestamp_ntz"
    ),
    "consultation_analysis": schema(
        "analysis_id bigint, case_id bigint, analyzer_version bigint, job_instance_id bigint, updated_at timestamp_ntz"
    ),
    "analysis_dispatch_outbox": schema(
        "request_id string, job_instance_id bigint, chunk_id string, analysis_version string, "
        "dispatch_status string, attempt_count int, next_retry_at timestamp_ntz, last_error string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, type string, claim_token bigint, "
        "claimed_started_at timestamp_ntz, claimed_done_at timestamp_ntz"
    ),
}

# The tables each job refuses to start without. The index job asks for three
# product detail tables none of its queries read.
REQUIRED_TABLES = {
    "event_features": ["user_event_features_7d"],
    "weekly_index": [
        "member", "subscription", "product", "addon_service", "internet", "iptv", "mobile_plan", "tab_watch_plan",
        "member_coupon", "usage_monthly", "support_case", "billing", "user_event_features_7d",
        "index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot",
    ],
    "member_context": [
        "member", "subscription", "product", "mobile_plan", "support_case", "usage_monthly",
        "user_event_features_7d", "index_persona_snapshot", "index_tscore_snapshot",
        "churn_score_snapshot", "member_context",
    ],
}
