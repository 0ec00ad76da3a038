"""Profile operators on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest

from memberlytics.operators import activity, profile, quality
from memberlytics.params import RunParams
from memberlytics.schemas import SCHEMAS

AS_OF = date(2024, 1, 30)
NOW = datetime(2024, 1, 30, 12)
DAY = timedelta(days=1)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def features(spark, *rows):
    return frame(spark, "user_event_features_7d", [(day, m, *[0] * 7, clicks, tags) for day, m, clicks, tags in rows])


def test_logs_of_the_last_fifteen_days(spark):
    logs = features(
        spark,
        (AS_OF - 14 * DAY, 1, "in", "[]"), (AS_OF - 15 * DAY, 2, "out", "[]"), (AS_OF + DAY, 3, "out", "[]"),
        (AS_OF, 4, "new", "[]"), (AS_OF - DAY, 4, "old", "[]"), (AS_OF + DAY, 4, "future", "[]"),
    )
    found = {r.member_id: r.product_type_clicks for r in activity.latest_logs(logs, AS_OF).collect()}
    assert found == {1: "in", 4: "new"}


def test_recent_counseling(spark):
    def case(case_id, member, title, day):
        return (case_id, member, title, None, None if day is None else datetime(2024, 1, day), None, None)

    rows = [
        case(1, 1, "first", 1), case(2, 1, "  ", 9), case(3, 1, "second", 2), case(4, 1, None, 8), case(5, 1, "fourth", 4), case(6, 1, "third", 3),
        case(7, 2, "tie low", 5), case(8, 2, "tie high", 5), case(9, 3, "dated", 5), case(10, 3, "undated", None), case(11, 4, "", 5),
    ]
    found = {r.member_id: r.recent_counseling for r in activity.recent_counseling(frame(spark, "support_case", rows)).collect()}
    assert found == {1: "fourth | third | second", 2: "tie high | tie low", 3: "undated | dated"}


def test_latest_by_may_look_ahead_unless_bounded(spark):
    rows = [(1, AS_OF - DAY, 10, "LOW"), (1, AS_OF + DAY, 90, "HIGH"), (2, AS_OF, 5, "LOW"), (3, AS_OF + DAY, 1, "LOW")]
    churn = frame(spark, "churn_score_snapshot", rows)
    assert {r.member_id: r.churn_tier for r in activity.latest_churn(churn).collect()} == {1: "HIGH", 2: "LOW", 3: "LOW"}
    assert {r.member_id: r.churn_tier for r in activity.latest_churn(churn, up_to=AS_OF).collect()} == {1: "LOW", 2: "LOW"}


@pytest.fixture(scope="module")
def tables(spark):
    start = date(2023, 1, 31)
    return {
        "member": frame(
            spark,
            "member",
            [(1, "VIP", date(1990, 1, 31), 2, 7, "OWNER"), (2, None, None, None, None, None), (3, "GOLD", date(1980, 5, 5), 0, 7, "MEMBER")],
        ),
        "product": frame(spark, "product", [(1, "Plan", "MOBILE_PLAN"), (2, "Net", "INTERNET")]),
        "mobile_plan": frame(spark, "mobile_plan", [(1, "10GB", None)]),
        "subscription": frame(
            spark,
            "subscription",
            [
                (1, 1, 1, True, start, None, AS_OF), (2, 2, 1, True, AS_OF, None, None), (3, 3, 2, True, start, None, None),
                (4, 3, 1, True, AS_OF - 9 * DAY, AS_OF - DAY, None),
            ],
        ),
        "usage_monthly": frame(spark, "usage_monthly", [(1, "202312", '{"data_gb": 10.1}'), (2, "202401", '{"data_gb": 1}')]),
        "support_case": frame(spark, "support_case", [(1, 1, "Billing", None, NOW, None, None)]),
        "churn_score_snapshot": frame(spark, "churn_score_snapshot", [(2, AS_OF, 88, "HIGH")]),
        "user_event_features_7d": features(spark, (AS_OF, 1, '{"IPTV":1}', '["eco"]')),
        "index_persona_snapshot": frame(spark, "index_persona_snapshot", [(AS_OF, 1, 1, "SPACE_SURFER", "benefit_trend", 60.0)]),
        "index_tscore_snapshot": frame(spark, "index_tscore_snapshot", [(AS_OF, 1, *[50.0] * 6)]),
    }


def test_context_rows(spark, tables):
    built = profile.build_member_context(tables, RunParams(AS_OF, "202312"), NOW)
    assert built.schema.names == SCHEMAS["member_context"].names
    rows = {r.member_id: r.asDict() for r in built.collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["age_group"], one["join_months"], one["children_count"], one["family_group_num"]) == ("30대", 11, 2, 2)
    assert (one["current_data_usage_ratio"], one["data_usage_pattern"], one["segment"]) == (101, "OVER", "UPSELL")
    assert (one["contract_expiry_within_3m"], one["persona_code"], one["recent_counseling"]) == (True, "SPACE_SURFER", "Billing")
    assert (one["product_type_clicks"], one["recent_viewed_tags_top_3"], one["churn_tier"]) == ('{"IPTV":1}', '["eco"]', None)
    two = rows[2]
    assert (two["age_group"], two["join_months"], two["children_count"], two["family_group_num"]) == ("대", 0, 0, 0)
    assert (two["current_data_usage_ratio"], two["data_usage_pattern"], two["segment"], two["churn_score"]) == (None, None, "CHURN_RISK", 88)
    assert (two["contract_expiry_within_3m"], two["persona_code"], two["recent_counseling"]) == (False, None, None)
    assert (two["product_type_clicks"], two["recent_viewed_tags_top_3"]) == (None, "[]")
    assert two["updated_at"] == NOW


def test_context_check(spark, tables):
    built = profile.build_member_context(tables, RunParams(AS_OF, "202312"), NOW)
    check = quality.check_member_context(tables["subscription"], tables["product"], built, built)
    # Member 3's plan has ended but is still switched on: eligible to the check, not to the builder.
    assert check.first().asDict() == {
        "eligible_count": 3, "context_count": 2, "null_pk_count": 0, "invalid_segment_count": 0, "null_product_types_count": 0, "built_count": 2,
    }
    with pytest.raises(quality.CheckFailed, match="3 eligible members but 2 profiles"):
        quality.require_member_context(check)


@pytest.mark.parametrize("broken", ["null_pk_count", "invalid_segment_count", "null_product_types_count"])
def test_context_check_fails_on_bad_rows(spark, broken):
    row = {"eligible_count": 2, "context_count": 2, "null_pk_count": 0, "invalid_segment_count": 0, "null_product_types_count": 0}
    quality.require_member_context(spark.createDataFrame([row]))
    with pytest.raises(quality.CheckFailed, match=broken):
        quality.require_member_context(spark.createDataFrame([{**row, broken: 1}]))


def test_bad_context_rows_are_counted(spark, tables):
    names = SCHEMAS["member_context"].names
    values = [{"member_id": 1, "segment": "NORMAL", "current_product_types": "{}"}, {"member_id": None, "segment": "VIP"}, {"member_id": 3}]
    context = frame(spark, "member_context", [tuple(v.get(n) for n in names) for v in values])
    check = quality.check_member_context(tables["subscription"], tables["product"], context).first()
    assert tuple(check) == (3, 3, 1, 2, 2)


def test_null_and_count_checks(spark):
    tscores = frame(spark, "index_tscore_snapshot", [(AS_OF, 1, *[50.0] * 5, None), (AS_OF, 2, *[50.0] * 6), (AS_OF - DAY, 3, *[None] * 6)])
    check = quality.check_nulls(tscores, quality.TSCORE_COLUMNS, AS_OF)
    assert check.first().null_count == 1
    with pytest.raises(quality.CheckFailed, match="1 T-score rows"):
        quality.require_no_nulls(check, "T-score")
    with pytest.raises(quality.CheckFailed, match="empty"):
        quality.require_not_empty(quality.check_not_empty(tscores, AS_OF + DAY), "T-score")
    member = spark.range(3)
    counts = quality.check_index_counts(member, tscores, tscores, tscores, AS_OF)
    assert tuple(counts.first()) == (3, 2, 2, 2)
    with pytest.raises(quality.CheckFailed):
        quality.require_index_counts(counts)
    quality.require_index_counts(quality.check_index_counts(spark.range(2), tscores, tscores, tscores, AS_OF))


def test_usage_amounts_too_large_are_counted(spark):
    texts = ['{"data_gb": 5}', '{"data_gb": "5.25"}', '{"data_gb": "n/a"}', "[]", None, '{"data_gb": "123456789012345"}', '{"data_gb": 1e30}', '{"data_gb": "12345678901234"}']
    usage = frame(spark, "usage_monthly", [(k, "202312", text) for k, text in enumerate(texts)] + [(99, "202401", texts[5])])
    assert tuple(quality.check_usage_amounts(usage, "202312").first()) == (8, 3, 2)
