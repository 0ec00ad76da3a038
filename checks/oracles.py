"""DuckDB twins of the queries, on the same Parquet tables.

Twins share common table expressions; each twin is a full statement holding the ones it uses.
"""

from __future__ import annotations

import re

from checks.inputs import AS_OF, FEATURE_DATES, INDEX_DATES, TABLES, duckdb_tables

# Fixed values, spelled out here so that a wrong one in the code under test is seen.
INDEX_CODES = ['explore', 'benefit_trend', 'multi_device', 'family_home', 'internet_security', 'stability']
MEMBERSHIP_POINTS = {'VVIP': 100, 'VIP': 80, 'GOLD': 60, 'BASIC': 40}
PERSONA_BY_INDEX = {'explore': 'SPACE_SHERLOCK',
 'benefit_trend': 'SPACE_SURFER',
 'multi_device': 'SPACE_OCTOPUS',
 'family_home': 'SPACE_GRAVITY',
 'internet_security': 'SPACE_GUARDIAN',
 'stability': 'SPACE_EXPLORER'}
UPSELL_TAGS = ['OTT프리미엄', '가족결합메인', '가족공유', '테더링쉐어링']
EVENT_BY_COLUMN = {'click_list_type_cnt': 'click_list_type',
 'click_product_detail_cnt': 'click_product_detail',
 'click_compare_cnt': 'click_compare',
 'click_coupon_cnt': 'click_coupon',
 'click_penalty_cnt': 'click_penalty',
 'click_change_cnt': 'click_change',
 'click_change_success_cnt': 'click_change_success'}
LONG_WINDOW_COLUMN = 'click_change_success_cnt'
PRODUCT_TYPES = ['MOBILE_PLAN', 'INTERNET', 'IPTV', 'TAB_WATCH_PLAN', 'ADDON']

TODAY = f"DATE '{AS_OF}'"
NOW = "TIMESTAMP '2024-01-30 12:00:00'"
MONTH = "'202312'"


def dates(days: list) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in days) + ") v(as_of)"


def each(template: str, items, sep: str = ", ") -> str:
    return sep.join(template.format(i) for i in items)


def recent(days: int) -> str:
    return f"day > as_of - {days} AND day <= as_of"


def case_map(column: str, values: dict, default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + f" ELSE {default} END"


def json_list(value: str, order: str) -> str:
    return f"'[' || string_agg({value}, ',' ORDER BY {order}) || ']'"


SHARED: dict[str, str] = {
    "run_dates": dates(FEATURE_DATES),
    "index_dates": dates(INDEX_DATES),
    # event features
    "ev": """
        SELECT as_of, member_id, event_name, CAST(left(timestamp, 10) AS DATE) AS day, upper(product_type) AS kind, tags
        FROM event_log JOIN run_dates ON CAST(dt AS DATE) > as_of - 90 AND CAST(dt AS DATE) <= as_of""",
    "click_counts": "SELECT as_of AS snapshot_date, member_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE event_name = '{event}' AND {recent(90 if column == LONG_WINDOW_COLUMN else 7)}) AS {column}"
        for column, event in EVENT_BY_COLUMN.items()
    )
    + " FROM ev GROUP BY ALL",
    "kind_clicks": f"""
        SELECT as_of, member_id, '{{' || string_agg('"' || kind || '":' || n, ',' ORDER BY kind) || '}}' AS product_type_clicks
        FROM (SELECT as_of, member_id, kind, count(*) AS n FROM ev WHERE kind IS NOT NULL AND {recent(7)} GROUP BY ALL) k GROUP BY ALL""",
    "tag_totals": f"""
        SELECT as_of, member_id, tag, count(*) AS tag_cnt
        FROM (SELECT as_of, member_id, unnest(tags) AS tag FROM ev WHERE event_name = 'click_product_detail' AND {recent(7)}) t
        GROUP BY ALL""",
    "tag_tops": f"""
        SELECT as_of, member_id, {json_list("to_json(tag)", "tag_cnt DESC, tag")} AS product_type_top_tags
        FROM (SELECT * FROM tag_totals QUALIFY row_number() OVER (PARTITION BY as_of, member_id ORDER BY tag_cnt DESC, tag) < 4) t
        GROUP BY ALL""",
    "feature_rows": """
        SELECT c.*, coalesce(k.product_type_clicks, '{}') AS product_type_clicks, coalesce(t.product_type_top_tags, '[]') AS product_type_top_tags
        FROM click_counts c LEFT JOIN kind_clicks k ON k.as_of = c.snapshot_date AND k.member_id = c.member_id
        LEFT JOIN tag_tops t ON t.as_of = c.snapshot_date AND t.member_id = c.member_id""",
    # subscriptions
    "live": """
        SELECT as_of, subscription_id, s.member_id, s.product_id, start_date, end_date, contract_end_date, name AS product_name, product_type
        FROM subscription s JOIN product p USING (product_id) JOIN index_dates ON as_of BETWEEN start_date AND coalesce(end_date, as_of)
        WHERE status""",
    "families": "SELECT family_group_id, count(*) AS family_member_cnt FROM member WHERE family_group_id IS NOT NULL GROUP BY ALL",
    "addons": """
        SELECT as_of, member_id, sum(CASE WHEN addon_type = 'SECURITY' THEN 1 ELSE 0 END)::BIGINT AS security_addon_cnt, count(*) AS addon_subscribe_cnt
        FROM live JOIN addon_service USING (product_id) GROUP BY ALL""",
    "nets": """
        SELECT as_of, member_id, internet::INT AS internet_flag, (internet AND iptv)::INT AS has_internet_iptv_bundle
        FROM (SELECT as_of, member_id, bool_or(product_type = 'INTERNET') AS internet, bool_or(product_type = 'IPTV') AS iptv FROM live GROUP BY ALL) n""",
    "gadgets": """
        SELECT as_of, member_id, coalesce(bool_or(plan AND watch), false)::INT AS watch_flag, coalesce(bool_or(plan AND NOT watch), false)::INT AS tablet_flag
        FROM (SELECT as_of, member_id, product_type = 'TAB_WATCH_PLAN' AS plan, regexp_matches(lower(product_name), 'watch|wearable') AS watch FROM live) g
        GROUP BY ALL""",
    "mobile": "SELECT live.*, data_amount, tethering_sharing_data FROM live JOIN mobile_plan USING (product_id) WHERE product_type = 'MOBILE_PLAN'",
    "limits": """
        SELECT as_of, member_id, coalesce(max(CASE WHEN regexp_full_match(digits, '[0-9]+') THEN digits::DOUBLE END), 0) AS sharing_limit_gb
        FROM (SELECT as_of, member_id, regexp_replace(tethering_sharing_data, '[^0-9.]', '', 'g') AS digits FROM mobile) d GROUP BY ALL""",
    "shared_amounts": f"""
        SELECT as_of, member_id, CASE WHEN json_type(usage_details) = 'OBJECT' THEN usage_details ->> 'tethering_sharing_data_gb' END AS amount
        FROM live JOIN usage_monthly USING (subscription_id) WHERE yyyymm = {MONTH} AND product_type = 'MOBILE_PLAN'""",
    "shared_usage": """
        SELECT as_of, member_id, sum(CASE WHEN regexp_full_match(amount, '[0-9]+') THEN amount::DOUBLE ELSE 0 END) AS sharing_used_gb
        FROM shared_amounts GROUP BY ALL""",
    # other index inputs
    "coupons": """
        SELECT as_of, member_id, count(*) AS coupon_used_cnt FROM member_coupon
        JOIN index_dates ON used_at::DATE > as_of - 7 AND used_at::DATE <= as_of WHERE is_used GROUP BY ALL""",
    "ratings": f"""
        SELECT member_id, avg(satisfaction_score) AS avg_monthly_satisfaction FROM support_case
        WHERE strftime(coalesce(resolved_at, updated_at), '%Y%m') = {MONTH} AND satisfaction_score IS NOT NULL GROUP BY ALL""",
    "index_rows": """
        SELECT d.as_of, m.member_id, m.membership, coalesce(m.children_count, 0) AS children, coalesce(f.family_member_cnt, 0) AS family,
          coalesce(a.addon_subscribe_cnt, 0) AS addons, coalesce(a.security_addon_cnt, 0) AS security, coalesce(n.internet_flag, 0) AS internet,
          coalesce(n.has_internet_iptv_bundle, 0) AS bundle, coalesce(g.watch_flag, 0) + coalesce(g.tablet_flag, 0) AS devices,
          coalesce(l.sharing_limit_gb, 0) AS sharing_limit, coalesce(u.sharing_used_gb, 0) AS sharing_used, coalesce(c.coupon_used_cnt, 0) AS coupons,
          coalesce(r.avg_monthly_satisfaction, 0) AS rating, coalesce(b.is_paid, false) AS paid,
          coalesce(e.click_product_detail_cnt, 0) AS details, coalesce(e.click_compare_cnt, 0) AS compares, coalesce(e.click_change_success_cnt, 0) AS changes
        FROM member m CROSS JOIN index_dates d LEFT JOIN families f USING (family_group_id)
        LEFT JOIN addons a ON a.as_of = d.as_of AND a.member_id = m.member_id LEFT JOIN nets n ON n.as_of = d.as_of AND n.member_id = m.member_id
        LEFT JOIN gadgets g ON g.as_of = d.as_of AND g.member_id = m.member_id LEFT JOIN limits l ON l.as_of = d.as_of AND l.member_id = m.member_id
        LEFT JOIN shared_usage u ON u.as_of = d.as_of AND u.member_id = m.member_id LEFT JOIN coupons c ON c.as_of = d.as_of AND c.member_id = m.member_id
        LEFT JOIN ratings r ON r.member_id = m.member_id LEFT JOIN billing b ON b.member_id = m.member_id AND b.yyyymm = '202312'
        LEFT JOIN click_counts e ON e.snapshot_date = d.as_of AND e.member_id = m.member_id""",
    "raw_rows": f"""
        SELECT as_of AS snapshot_date, member_id,
          ln(1 + details) + 3 * ln(1 + compares) AS explore_raw,
          ln(1 + addons) + ln(1 + coupons) + ln(1 + changes) AS benefit_trend_raw,
          devices + CASE WHEN sharing_limit > 0 THEN greatest(0, least(1, sharing_used / sharing_limit)) ELSE 0 END AS multi_device_raw,
          ln(1 + family) + bundle + ln(1 + children) AS family_home_raw,
          0.7::DOUBLE * internet + 0.3::DOUBLE * ln(1 + security) AS internet_security_raw,
          ({case_map("membership", MEMBERSHIP_POINTS, "0")} + rating / 5 * 100 + CASE WHEN paid THEN 100 ELSE 0 END) / 3.0::DOUBLE AS stability_raw
        FROM index_rows""",
    "tscore_rows": "SELECT snapshot_date, member_id, "
    + each(
        "CASE WHEN min({0}_raw) OVER d = max({0}_raw) OVER d THEN 50.0::DOUBLE "
        "ELSE 50 + 10 * ({0}_raw - avg({0}_raw) OVER d) / stddev_pop({0}_raw) OVER d END AS {0}_tscore",
        INDEX_CODES,
    )
    + " FROM raw_rows WINDOW d AS (PARTITION BY snapshot_date)",
    "score_list": "SELECT * FROM (" + each(
        "SELECT snapshot_date, member_id, '{0}' AS index_code, {0}_tscore AS tscore FROM tscore_rows", INDEX_CODES, " UNION ALL "
    ) + ") s",
    "winners": """
        SELECT snapshot_date, member_id, index_code AS source_index_code, tscore AS source_tscore FROM score_list
        QUALIFY row_number() OVER (PARTITION BY snapshot_date, member_id ORDER BY tscore DESC NULLS FIRST, index_code) = 1""",
    "definitions": """
        SELECT character_name, persona_type_id FROM persona_type WHERE is_active
        QUALIFY row_number() OVER (PARTITION BY character_name ORDER BY version DESC, persona_type_id DESC) = 1""",
    "persona_rows": f"""
        SELECT snapshot_date, member_id, persona_type_id, persona_code, source_index_code, source_tscore
        FROM (SELECT *, {case_map("source_index_code", PERSONA_BY_INDEX, "'SPACE_SHERLOCK'")} AS persona_code FROM winners) w
        JOIN definitions ON character_name = persona_code""",
    # profile
    "first_plans": """
        SELECT as_of, member_id, subscription_id, start_date, data_amount FROM mobile
        QUALIFY row_number() OVER (PARTITION BY as_of, member_id ORDER BY start_date, subscription_id) = 1""",
    "newest_churn": """
        SELECT member_id, arg_max(churn_score, base_date) AS churn_score, arg_max(risk_level, base_date) AS churn_tier
        FROM churn_score_snapshot GROUP BY ALL""",
    "newest_persona": "SELECT member_id, arg_max(persona_code, snapshot_date) AS persona_code FROM persona_rows GROUP BY ALL",
    "newest_tscore": "SELECT member_id, "
    + each("arg_max({0}_tscore, snapshot_date) AS {0}_tscore", ["explore", "benefit_trend", "multi_device", "family_home"])
    + " FROM tscore_rows GROUP BY ALL",
    "newest_logs": """
        SELECT as_of, member_id, arg_max(product_type_clicks, snapshot_date) AS product_type_clicks,
          arg_max(product_type_top_tags, snapshot_date) AS product_type_top_tags
        FROM feature_rows JOIN index_dates ON snapshot_date BETWEEN as_of - 14 AS_OF_END GROUP BY ALL""".replace("AS_OF_END", "AND as_of"),
    "subscription_lists": f"""
        SELECT as_of, member_id, {json_list(
            '''concat('{"product_id":', product_id, ',"product_name":', to_json(product_name), ',"product_type":"', product_type, '","start_date":"', start_date, '"}')''',
            "start_date, subscription_id")} AS current_subscriptions
        FROM live GROUP BY ALL""",
    "type_flags": "SELECT as_of, member_id, concat('{', "
    + each("""'"{0}":', bool_or(product_type = '{0}')""", PRODUCT_TYPES, ", ',', ")
    + ", '}') AS current_product_types FROM live GROUP BY ALL",
    "titles": f"""
        SELECT member_id, string_agg(title, ' | ' ORDER BY created_at DESC, case_id DESC) AS recent_counseling
        FROM (SELECT * FROM support_case WHERE length(trim(title)) > 0
          QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY created_at DESC, case_id DESC) < 4) t GROUP BY ALL""",
    # Tenths of a GB as integers: the quotient is rounded and compared exactly.
    "usage_tenths": f"""
        SELECT as_of, member_id,
          CASE WHEN regexp_full_match(data_amount, '[0-9]+([.][0-9]+)?GB') THEN round(replace(data_amount, 'GB', '')::DOUBLE * 10)::BIGINT END AS allowance,
          CASE WHEN regexp_full_match(used, '[0-9]+([.][0-9]+)?') THEN round(used::DOUBLE * 10)::BIGINT END AS used
        FROM (SELECT f.*, CASE WHEN json_type(usage_details) = 'OBJECT' THEN usage_details ->> 'data_gb' END AS used
          FROM first_plans f LEFT JOIN usage_monthly u ON u.subscription_id = f.subscription_id AND u.yyyymm = {MONTH}) x""",
    "usage_rows": """
        SELECT as_of, member_id, used::DOUBLE / allowance AS usage_ratio,
          ((200 * used + allowance) // (2 * allowance))::INT AS current_data_usage_ratio,
          CASE WHEN used > allowance THEN 'OVER' WHEN used * 10 > allowance * 6 THEN 'FIT' WHEN used IS NOT NULL THEN 'UNDER' END AS data_usage_pattern
        FROM (SELECT as_of, member_id, CASE WHEN used IS NOT NULL AND allowance > 0 THEN allowance END AS allowance,
          CASE WHEN allowance > 0 THEN used END AS used FROM usage_tenths) t""",
    "expiring": """
        SELECT as_of, member_id, bool_or(product_type <> 'ADDON' AND coalesce(contract_end_date >= as_of AND contract_end_date < as_of + INTERVAL 3 MONTH, false))
          AS contract_expiry_within_3m FROM live GROUP BY ALL""",
    "tag_hints": "SELECT snapshot_date, member_id, len(list_filter(CAST(product_type_top_tags AS JSON)::VARCHAR[], lambda t: t IN ("
    + each("'{0}'", UPSELL_TAGS)
    + "))) AS hints, product_type_top_tags FROM feature_rows",
    "profile_rows": f"""
        SELECT f.as_of, m.member_id, m.membership, concat(CAST(date_part('year', age(f.as_of, m.birth_date)) AS INT) // 10 * 10, '대') AS age_group,
          CAST(date_part('year', age(f.as_of, f.start_date)) * 12 + date_part('month', age(f.as_of, f.start_date)) AS INT) AS join_months,
          coalesce(m.children_count, 0) AS children_count, coalesce(fam.family_member_cnt, 0)::INT AS family_group_num, m.family_role, p.persona_code,
          CASE WHEN c.churn_tier = 'HIGH' THEN 'CHURN_RISK'
            WHEN u.data_usage_pattern = 'OVER' OR len(list_filter(CAST(coalesce(e.product_type_top_tags, '[]') AS JSON)::VARCHAR[],
              lambda t: t IN ({each("'{0}'", UPSELL_TAGS)}))) >= 2
              OR t.benefit_trend_tscore >= 55 OR t.explore_tscore >= 55 OR t.multi_device_tscore >= 60 OR t.family_home_tscore >= 60 THEN 'UPSELL'
            ELSE 'NORMAL' END AS segment,
          s.current_subscriptions, k.current_product_types, u.current_data_usage_ratio, u.data_usage_pattern, c.churn_score, c.churn_tier,
          r.recent_counseling, e.product_type_clicks, coalesce(e.product_type_top_tags, '[]') AS recent_viewed_tags_top_3,
          coalesce(x.contract_expiry_within_3m, false) AS contract_expiry_within_3m, {NOW} AS updated_at
        FROM first_plans f JOIN member m USING (member_id) LEFT JOIN families fam USING (family_group_id)
        LEFT JOIN newest_persona p ON p.member_id = m.member_id LEFT JOIN newest_tscore t ON t.member_id = m.member_id
        LEFT JOIN newest_churn c ON c.member_id = m.member_id LEFT JOIN titles r ON r.member_id = m.member_id
        LEFT JOIN newest_logs e ON e.as_of = f.as_of AND e.member_id = m.member_id LEFT JOIN subscription_lists s ON s.as_of = f.as_of AND s.member_id = m.member_id
        LEFT JOIN type_flags k ON k.as_of = f.as_of AND k.member_id = m.member_id LEFT JOIN usage_rows u ON u.as_of = f.as_of AND u.member_id = m.member_id
        LEFT JOIN expiring x ON x.as_of = f.as_of AND x.member_id = m.member_id""",
    # claim and dispatch
    "keyed": "SELECT *, sha256(case_id || ':' || analyzer_version) AS request_id FROM consultation_analysis",
    "fresh": "SELECT case_id, row_number() OVER (ORDER BY case_id) AS place FROM support_case WHERE case_id NOT IN (SELECT case_id FROM consultation_analysis)",
    "open_rows": f"""
        SELECT k.analysis_id, k.case_id, k.analyzer_version, k.request_id FROM keyed k LEFT JOIN analysis_dispatch_outbox o USING (request_id)
        WHERE o.request_id IS NULL OR (o.dispatch_status IN ('READY', 'RETRY') AND coalesce(o.next_retry_at, {NOW}) <= {NOW}
          AND (o.claimed_started_at IS NULL OR o.claimed_done_at IS NOT NULL OR o.claimed_started_at < {NOW} - INTERVAL 1800 SECOND))""",
    "taken": "SELECT * FROM open_rows ORDER BY analysis_id LIMIT 1000",
    "waiting_targets": """
        SELECT k.analysis_id, k.case_id, k.analyzer_version, request_id FROM keyed k JOIN analysis_dispatch_outbox o USING (request_id)
        WHERE o.claim_token = 3 AND o.dispatch_status IN ('READY', 'RETRY') AND o.claimed_done_at IS NULL""",
    "mixed_keyed": "SELECT *, sha256(case_id || ':' || analyzer_version) AS request_id FROM consultation_analysis_mixed",
    # Requests that a row of their own type holds back.
    "mixed_held": f"""
        SELECT request_id FROM analysis_dispatch_outbox_mixed
        WHERE type = 'REQUEST' AND (dispatch_status NOT IN ('READY', 'RETRY') OR next_retry_at > {NOW}
          OR (claimed_done_at IS NULL AND claimed_started_at >= {NOW} - INTERVAL 1800 SECOND))""",
    "mixed_open": """
        SELECT analysis_id, case_id, analyzer_version, request_id FROM mixed_keyed
        WHERE analyzer_version = 1 AND request_id NOT IN (SELECT request_id FROM mixed_held)""",
    "mixed_answered": """
        SELECT o.*, case_id FROM analysis_dispatch_outbox_mixed o JOIN mixed_keyed k USING (request_id)
        WHERE type = 'REQUEST' AND analyzer_version = 1 AND case_id % 3 <> 0""",
    "mixed_taken": "SELECT * FROM mixed_open ORDER BY analysis_id LIMIT 1000",
}


def attempted(source: str, base: str = "attempt_count") -> str:
    """Outcome columns of one delivery attempt on rows of `source` (with `case_id`)."""
    failed = "case_id % 4 = 0"
    return f"""
        SELECT request_id, CASE WHEN NOT ({failed}) THEN 'SENT' WHEN {base} + 1 >= 3 THEN 'DEAD' ELSE 'RETRY' END AS dispatch_status,
          CAST({base} + 1 AS INT) AS attempt_count,
          CASE WHEN {failed} AND {base} + 1 < 3 THEN {NOW} + to_seconds(CAST(60 * 2 ** {base} AS BIGINT)) END AS next_retry_at,
          CASE WHEN {failed} THEN repeat('e', 1000) END AS last_error, {NOW} AS claimed_done_at"""


OUTBOX_COLUMNS = (
    "request_id, job_instance_id, chunk_id, analysis_version, dispatch_status, attempt_count, next_retry_at, last_error, "
    "created_at, updated_at, type, claim_token, claimed_started_at, claimed_done_at"
)


def today(source: str, columns: str = "* EXCLUDE (as_of)", date_column: str = "as_of") -> str:
    return f"SELECT {columns} FROM {source} WHERE {date_column} = {TODAY}"


def rounded(names) -> str:
    return each("round({0}, 6) AS {0}", names)


SNAPSHOT = "snapshot_date"
RAW_NAMES = [f"{code}_raw" for code in INDEX_CODES]
TSCORE_NAMES = [f"{code}_tscore" for code in INDEX_CODES]

SELECTS: dict[str, str] = {
    "p1_event_counts": today("click_counts", "*", SNAPSHOT),
    "p1_product_type_clicks": today("kind_clicks"),
    "p1_tag_counts": today("tag_totals"),
    "p1_top_tags": today("tag_tops"),
    "p1_event_features": today("feature_rows", "*", SNAPSHOT),
    "active_subscriptions": today("live"),
    "base_members": "SELECT * REPLACE (coalesce(children_count, 0) AS children_count) FROM member",
    "family_counts": "SELECT * FROM families",
    "family_size": "SELECT member_id, family_group_id, coalesce(family_member_cnt, 0) AS family_member_cnt FROM member LEFT JOIN families USING (family_group_id)",
    "addon_features": today("addons"),
    "internet_iptv_features": today("nets"),
    "watch_tablet_features": today("gadgets"),
    "sharing_limit": today("limits"),
    "sharing_limit_decimals": f"""
        SELECT member_id, coalesce(max(CASE WHEN regexp_full_match(digits, '[0-9]+([.][0-9]+)?') THEN digits::DOUBLE END), 0) AS sharing_limit_gb
        FROM (SELECT member_id, regexp_replace(tethering_sharing_data, '[^0-9.]', '', 'g') AS digits FROM mobile WHERE as_of = {TODAY}) d GROUP BY ALL""",
    "sharing_used": today("shared_usage"),
    "sharing_used_decimals": f"""
        SELECT member_id, sum(CASE WHEN regexp_full_match(amount, '[0-9]+([.][0-9]+)?') THEN amount::DOUBLE ELSE 0 END) AS sharing_used_gb
        FROM shared_amounts WHERE as_of = {TODAY} GROUP BY ALL""",
    "index_rollup": f"""
        SELECT n.member_id, coalesce(security_addon_cnt, 0) AS security_addon_cnt, coalesce(addon_subscribe_cnt, 0) AS addon_subscribe_cnt,
          internet_flag, has_internet_iptv_bundle, watch_flag, tablet_flag, coalesce(sharing_limit_gb, 0) AS sharing_limit_gb
        FROM nets n JOIN gadgets USING (as_of, member_id) LEFT JOIN addons USING (as_of, member_id) LEFT JOIN limits USING (as_of, member_id)
        WHERE as_of = {TODAY}""",
    "coupon_7d": today("coupons"),
    "support_monthly": f"SELECT member_id, {rounded(['avg_monthly_satisfaction'])} FROM ratings",
    "billing_monthly": f"SELECT member_id, is_paid FROM billing WHERE yyyymm = {MONTH}",
    "log_features": today("click_counts", "member_id, click_product_detail_cnt, click_compare_cnt, click_change_success_cnt", SNAPSHOT),
    "raw_snapshot": today("raw_rows", f"snapshot_date, member_id, {rounded(RAW_NAMES)}", SNAPSHOT),
    **{name: today("raw_rows", f"member_id, {rounded([name])}", SNAPSHOT) for name in RAW_NAMES},
    "index_stats": today(
        "raw_rows",
        each(
            "round(avg({0}_raw), 6) AS {0}_mean, round(stddev_pop({0}_raw), 6) AS {0}_stddev, "
            "round(min({0}_raw), 6) AS {0}_min, round(max({0}_raw), 6) AS {0}_max",
            INDEX_CODES,
        ),
        SNAPSHOT,
    ),
    "tscore_snapshot": today("tscore_rows", f"snapshot_date, member_id, {rounded(TSCORE_NAMES)}", SNAPSHOT),
    "unpivot_scores": today("score_list", f"member_id, index_code, {rounded(['tscore'])}", SNAPSHOT),
    "winning_index": today("winners", f"member_id, source_index_code, {rounded(['source_tscore'])}", SNAPSHOT),
    "persona_code": today("score_list", f"member_id, index_code, {case_map('index_code', PERSONA_BY_INDEX, 'NULL')} AS persona_code", SNAPSHOT),
    "latest_persona_type": "SELECT * FROM definitions",
    "persona_snapshot": today("persona_rows", "* REPLACE (round(source_tscore, 6) AS source_tscore)", SNAPSHOT),
    "mobile_plan_subscription": today("first_plans"),
    "latest_persona": "SELECT * FROM newest_persona",
    "latest_tscore": "SELECT member_id, " + rounded(["explore_tscore", "benefit_trend_tscore", "multi_device_tscore", "family_home_tscore"]) + " FROM newest_tscore",
    "latest_churn": "SELECT * FROM newest_churn",
    "latest_churn_bounded": f"""
        SELECT member_id, arg_max(churn_score, base_date) AS churn_score, arg_max(risk_level, base_date) AS churn_tier
        FROM churn_score_snapshot WHERE base_date <= {TODAY} GROUP BY ALL""",
    "latest_logs": today("newest_logs"),
    "current_subscriptions": today("subscription_lists"),
    "current_product_types": today("type_flags"),
    "recent_counseling": "SELECT * FROM titles",
    "usage_metrics": today("usage_rows", "* EXCLUDE (as_of) REPLACE (round(usage_ratio, 6) AS usage_ratio)"),
    "contract_flags": today("expiring"),
    "age_and_tenure": today("profile_rows", "member_id, age_group, join_months"),
    "upsell_tag_count": today("tag_hints", "member_id, hints::INT AS upsell_tag_cnt", SNAPSHOT),
    "segment": today("profile_rows", "member_id, segment"),
    "member_context": today("profile_rows"),
    # A profile of the earlier date stays where the later date has none.
    "context_upsert": "SELECT * EXCLUDE (as_of) FROM profile_rows QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY as_of DESC) = 1",
    "request_id": "SELECT analysis_id, request_id FROM keyed",
    "seed_analyses": """
        SELECT (SELECT max(analysis_id) FROM consultation_analysis) + place AS analysis_id, case_id, 1::BIGINT AS analyzer_version,
          7::BIGINT AS job_instance_id, NULL::TIMESTAMP AS updated_at FROM fresh WHERE place <= 1000""",
    "insert_ignore": """
        SELECT analysis_id, case_id, analyzer_version, job_instance_id, updated_at FROM consultation_analysis
        UNION ALL SELECT case_id + 1000000000, case_id, 1, 7, NULL FROM fresh""",
    "backlog": "SELECT * FROM open_rows",
    "pickable": "SELECT * FROM taken",
    "claim_chunk": f"""
        SELECT {OUTBOX_COLUMNS} FROM analysis_dispatch_outbox WHERE request_id NOT IN (SELECT request_id FROM taken)
        UNION ALL SELECT t.request_id, 7, '900', '1', 'READY', coalesce(o.attempt_count, 0), NULL, NULL, coalesce(o.created_at, {NOW}), {NOW}, 'REQUEST', 900, {NOW}, NULL
        FROM taken t LEFT JOIN analysis_dispatch_outbox o USING (request_id)""",
    "claim_chunk_analyses": f"""
        SELECT c.analysis_id, c.case_id, c.analyzer_version, CASE WHEN t.case_id IS NULL THEN c.job_instance_id ELSE 7 END AS job_instance_id,
          CASE WHEN t.case_id IS NULL THEN c.updated_at ELSE {NOW} END AS updated_at
        FROM consultation_analysis c LEFT JOIN taken t USING (analysis_id)
        UNION ALL SELECT (SELECT max(analysis_id) FROM consultation_analysis) + place, case_id, 1, 7, NULL FROM fresh WHERE place <= 1000""",
    "claimed_targets": "SELECT * FROM waiting_targets",
    "dispatch_messages": """
        SELECT request_id AS key, concat('{"dispatchRequestId":"', request_id, '","caseId":', case_id, ',"analyzerVersion":', analyzer_version, '}') AS value
        FROM waiting_targets""",
    "message_sink_roundtrip": """
        SELECT request_id AS key, concat('{"dispatchRequestId":"', request_id, '","caseId":', case_id, ',"analyzerVersion":', analyzer_version, '}') AS value,
          true AS ok, CAST(NULL AS VARCHAR) AS error
        FROM keyed""",
    "dispatch_register": f"""
        SELECT request_id, 7::BIGINT AS job_instance_id, '900' AS chunk_id, '1' AS analysis_version, coalesce(o.dispatch_status, 'READY') AS dispatch_status,
          coalesce(o.attempt_count, 0) AS attempt_count, o.next_retry_at, o.last_error, coalesce(o.created_at, {NOW}) AS created_at, {NOW} AS updated_at,
          coalesce(o.type, 'REQUEST') AS type, o.claim_token, o.claimed_started_at, o.claimed_done_at
        FROM keyed LEFT JOIN analysis_dispatch_outbox o USING (request_id)""",
    "apply_results": f"""
        SELECT request_id, o.job_instance_id, chunk_id, analysis_version, a.dispatch_status, a.attempt_count, a.next_retry_at, a.last_error, created_at,
          {NOW} AS updated_at, type, claim_token, claimed_started_at, a.claimed_done_at
        FROM analysis_dispatch_outbox o JOIN ({attempted("o")} FROM analysis_dispatch_outbox JOIN keyed USING (request_id)) a USING (request_id)""",
    "dispatch_counts": """
        SELECT count(*) FILTER (WHERE NOT closed AND case_id % 4 <> 0) AS published, count(*) FILTER (WHERE closed) AS skipped,
          count(*) FILTER (WHERE NOT closed AND case_id % 4 = 0) AS retried
        FROM (SELECT case_id, coalesce(o.dispatch_status IN ('SENT', 'ACKED', 'DEAD'), false) AS closed
          FROM keyed LEFT JOIN analysis_dispatch_outbox o USING (request_id)) k""",
    # Every claimable request and every unseeded case is tried exactly once.
    "drain_dispatch": f"""
        SELECT request_id, dispatch_status, attempt_count, next_retry_at, last_error, claimed_done_at, created_at
        FROM analysis_dispatch_outbox WHERE request_id NOT IN (SELECT request_id FROM open_rows)
        UNION ALL {attempted("tried", "attempts")}, coalesce(created_at, {NOW}) AS created_at
        FROM (SELECT request_id, case_id, coalesce(o.attempt_count, 0) AS attempts, o.created_at
          FROM (SELECT request_id, case_id FROM open_rows UNION ALL SELECT sha256(case_id || ':1'), case_id FROM fresh) c
          LEFT JOIN analysis_dispatch_outbox o USING (request_id)) tried""",
    "backlog_mixed": "SELECT * FROM mixed_open",
    "backlog_second_version": "SELECT analysis_id, case_id, analyzer_version, request_id FROM mixed_keyed WHERE analyzer_version = 2",
    "claim_chunk_mixed": f"""
        SELECT {OUTBOX_COLUMNS} FROM analysis_dispatch_outbox_mixed WHERE request_id NOT IN (SELECT request_id FROM mixed_taken)
        UNION ALL SELECT t.request_id, 7, '900', '1', 'READY', coalesce(o.attempt_count, 0), NULL, NULL, coalesce(o.created_at, {NOW}), {NOW}, 'REQUEST', 900, {NOW}, NULL
        FROM mixed_taken t LEFT JOIN analysis_dispatch_outbox_mixed o USING (request_id)""",
    "claimed_targets_mixed": """
        SELECT k.analysis_id, k.case_id, k.analyzer_version, request_id FROM mixed_keyed k JOIN analysis_dispatch_outbox_mixed o USING (request_id)
        WHERE o.claim_token = 3 AND o.type = 'REQUEST' AND o.dispatch_status IN ('READY', 'RETRY') AND o.claimed_done_at IS NULL""",
    "apply_results_unanswered": f"""
        SELECT {OUTBOX_COLUMNS} FROM analysis_dispatch_outbox_mixed WHERE request_id NOT IN (SELECT request_id FROM mixed_answered)
        UNION ALL SELECT request_id, o.job_instance_id, chunk_id, analysis_version, a.dispatch_status, a.attempt_count, a.next_retry_at, a.last_error,
          created_at, {NOW}, type, claim_token, claimed_started_at, a.claimed_done_at
        FROM mixed_answered o JOIN ({attempted("mixed_answered")} FROM mixed_answered) a USING (request_id)""",
    "drain_dispatch_mixed": f"""
        SELECT request_id, dispatch_status, attempt_count, next_retry_at, last_error, claimed_done_at, created_at, type
        FROM analysis_dispatch_outbox_mixed WHERE request_id NOT IN (SELECT request_id FROM mixed_open)
        UNION ALL {attempted("tried", "attempts")}, coalesce(created_at, {NOW}) AS created_at, 'REQUEST' AS type
        FROM (SELECT request_id, case_id, coalesce(o.attempt_count, 0) AS attempts, o.created_at
          FROM (SELECT request_id, case_id FROM mixed_open UNION ALL SELECT sha256(case_id || ':1'), case_id FROM fresh) c
          LEFT JOIN analysis_dispatch_outbox_mixed o USING (request_id)) tried""",
    "table_read": "SELECT * FROM subscription",
    "usage_amounts_check": f"""
        SELECT count(*) AS document_count, count(*) FILTER (WHERE regexp_full_match(amount, '[0-9]+([.][0-9]+)?')) AS amount_count,
          count(*) FILTER (WHERE regexp_full_match(amount, '[0-9]{{15,}}([.][0-9]+)?')) AS too_large_count
        FROM (SELECT CASE WHEN json_type(usage_details) = 'OBJECT' THEN usage_details ->> '$.data_gb' END AS amount
          FROM usage_monthly WHERE yyyymm = {MONTH}) u""",
    "index_counts": "SELECT (SELECT count(*) FROM member) AS member_count, "
    + ", ".join(
        f"(SELECT count(*) FROM {source} WHERE snapshot_date = {TODAY}) AS {name}_count"
        for name, source in [("raw", "raw_rows"), ("tscore", "tscore_rows"), ("persona", "persona_rows")]
    ),
    "tscore_nulls": today("tscore_rows", "count(*) - count(" + " + ".join(TSCORE_NAMES) + ") AS null_count", SNAPSHOT),
    "persona_nulls": today(
        "persona_rows", "count(*) FILTER (WHERE persona_type_id IS NULL OR source_index_code IS NULL OR source_tscore IS NULL) AS null_count", SNAPSHOT
    ),
    "features_count": today("click_counts", "count(*) AS row_count", SNAPSHOT),
    "context_check": f"""
        SELECT (SELECT count(DISTINCT s.member_id) FROM subscription s JOIN product p USING (product_id) WHERE s.status AND p.product_type = 'MOBILE_PLAN') AS eligible_count,
          count(*) AS context_count, count(*) FILTER (WHERE member_id IS NULL) AS null_pk_count,
          count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ('CHURN_RISK', 'UPSELL', 'NORMAL')) AS invalid_segment_count,
          count(*) FILTER (WHERE current_product_types IS NULL) AS null_product_types_count, count(*) AS built_count
        FROM profile_rows WHERE as_of = {TODAY}""",
    "snapshot_replace": f"SELECT * FROM feature_rows WHERE snapshot_date IN ({TODAY}, DATE '{FEATURE_DATES[1]}')",
    "features_csv_roundtrip": today("feature_rows", "*", SNAPSHOT),
    "pruned_event_scan": f"""
        SELECT member_id, event_name, timestamp, product_type, to_json(tags)::VARCHAR AS tags, dt FROM event_log
        WHERE CAST(dt AS DATE) BETWEEN {TODAY} - 89 AND {TODAY}""",
}


def _names_in(text: str, known) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in known if name in words]


def statement(select: str) -> str:
    """`select` headed by the shared expressions and mapped tables it needs."""
    needed, todo = set(), _names_in(select, SHARED)
    texts = [select]
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            texts.append(SHARED[name])
            todo += _names_in(SHARED[name], SHARED)
    mapped = _names_in(" ".join(texts), TABLES)
    ctes = duckdb_tables(*mapped) + [f"{name} AS ({sql})" for name, sql in SHARED.items() if name in needed]
    return "WITH " + ",\n".join(ctes) + "\n" + select if ctes else select


# Repeated rows change nothing.
SELECTS["insert_ignore_repeated"] = SELECTS["insert_ignore"]
SELECTS["apply_results_repeated"] = SELECTS["apply_results"]
# Nor do stored sums per day, or a drain that was broken off and finished.
SELECTS["p1_event_features_incremental"] = SELECTS["p1_event_features"]
SELECTS["drain_dispatch_resumed"] = SELECTS["drain_dispatch"]
# The SQL functions give what the column expressions do.
for _name in ["active_subscriptions", "contract_flags", "raw_snapshot", "tscore_snapshot", "persona_code", "usage_metrics", "age_and_tenure", "segment"]:
    SELECTS[f"sql_{_name}"] = SELECTS[_name]

ORACLES = {name: statement(select) for name, select in SELECTS.items()}
