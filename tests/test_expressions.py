"""Column expressions on hand-made values."""

from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memberlytics.functions import dates, numbers, scores
from memberlytics.operators.profile import usage_ratio

AS_OF = date(2024, 1, 30)


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_age_group(spark):
    born = [date(1990, 1, 31), date(1994, 1, 30), date(1994, 1, 31), None, date(2024, 1, 1), date(2024, 2, 15)]
    groups = column(spark, born, "date", lambda c: dates.age_group(c, F.lit(AS_OF)))
    assert groups == ["30대", "30대", "20대", "대", "0대", "0대"]


def test_full_months(spark):
    starts = [date(2023, 1, 31), date(2023, 1, 30), date(2024, 1, 30), date(2022, 12, 1), None]
    months = column(spark, starts, "date", lambda c: dates.full_months(c, F.lit(AS_OF)))
    assert months == [11, 12, 0, 13, None]
    assert column(spark, [date(2000, 2, 29)], "date", lambda c: dates.full_months(c, F.lit(date(2023, 2, 28)))) == [275]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 20000), min_size=40, max_size=40), st.integers(18000, 20000))
def test_full_months_equals_calendar_age(spark, offsets, end):
    starts, end = [date(1970, 1, 1) + timedelta(days=o) for o in offsets], date(1970, 1, 1) + timedelta(days=end)
    starts = [s for s in starts if s <= end]
    months = column(spark, starts, "date", lambda c: dates.full_months(c, F.lit(end)))
    twin = duckdb.connect()
    for start, ours in zip(starts, months):
        years, rest = twin.execute("SELECT date_part('year', age(?, ?)), date_part('month', age(?, ?))", [end, start] * 2).fetchone()
        assert ours == years * 12 + rest


@pytest.mark.parametrize("kind,moment", [("date", date), ("timestamp_ntz", None)])
def test_day_window_includes_both_ends(spark, kind, moment):
    days = [AS_OF, AS_OF - timedelta(days=6), AS_OF - timedelta(days=7), AS_OF + timedelta(days=1), None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, v date")
    rows = rows.withColumn("v", F.col("v").cast(kind))
    if kind == "timestamp_ntz":
        rows = rows.withColumn("v", F.col("v") + F.expr("INTERVAL 23 HOURS 59 MINUTES"))
    hits = rows.where(dates.in_last_days(F.col("v"), AS_OF, 7)).select("i").collect()
    assert sorted(r.i for r in hits) == [0, 1]


def test_month_window(spark):
    days = [date(2023, 11, 30), date(2023, 12, 1), date(2023, 12, 31), date(2024, 1, 1)]
    assert column(spark, days, "date", lambda c: dates.in_month(c, "202312")) == [False, True, True, False]


def test_digits_number(spark):
    texts = ["55GB", "5.5GB", "5G 55GB", "none", None, "1.2.3", "7\n"]
    strict = column(spark, texts, "string", numbers.digits_number)
    loose = column(spark, texts, "string", lambda c: numbers.digits_number(c, whole_only=False))
    assert strict == [55.0, None, 555.0, None, None, None, 7.0]
    assert loose == [55.0, 5.5, 555.0, None, None, None, 7.0]


def test_json_number(spark):
    documents = [
        '{"a": "12"}', '{"a": 12}', '{"a": "1.5"}', '{"a": 1.5}', '{"b": 1}', '[]', '[{"a": 1}]', '"a"', None,
        '{"a": "12\\n"}', '{"a": null}', '{"a": "-1"}', ' {"a": 3}', '{"a": 12345678.5}', '{"a": 0.1}',
        '{"a": 0.0005}', '{"a": "5.0E-4"}', '{"a": 1, "a": 2}', '{"a": {"a": 1}}', 'no json', '{"a": -0.0005}',
    ]
    loose = column(spark, documents, "string", lambda c: numbers.json_number(c, "a"))
    wanted = ["12", "12", "1.5", "1.5", None, None, None, None, None, None, None, None, "3", "12345678.5", "0.1", "0.0005", None, "2", None, None, None]
    assert loose == [None if w is None else Decimal(w) for w in wanted]
    strict = column(spark, documents[:4], "string", lambda c: numbers.json_number(c, "a", "double", whole_only=True))
    assert strict == [12.0, 12.0, None, None]


def test_parse_allowance(spark):
    texts = ["12GB", "12.5GB", "monthly 12GB", "unlimited", "12gb", "12GB\n", None]
    assert column(spark, texts, "string", numbers.parse_allowance) == [Decimal(12), Decimal("12.5")] + [None] * 5


def test_count_tags_in(spark):
    texts = ['["가족공유","eco","가족공유"]', "[]", None, '["kids"]', '["OTT프리미엄","테더링쉐어링","가족결합메인"]']
    assert column(spark, texts, "string", lambda c: numbers.count_tags_in(c, scores.UPSELL_TAGS)) == [2, 0, 0, 0, 3]


def test_usage_ratio_percent_and_pattern(spark):
    pairs = [("10", "10"), ("6", "10"), ("6.1", "10"), ("10.1", "10"), (None, "10"), ("5", "0"), ("5", None), ("22.5", "20"), ("0.3", "0.5")]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, used string, allowed string").orderBy("i")
    ratio = usage_ratio(F.col("allowed").cast(numbers.GB_TYPE), F.col("used").cast(numbers.GB_TYPE))
    found = rows.select(scores.usage_percent(ratio), scores.usage_pattern(ratio)).collect()
    assert [tuple(r) for r in found] == [
        (100, "FIT"), (60, "UNDER"), (61, "FIT"), (101, "OVER"), (None, None), (None, None), (None, None), (113, "OVER"), (60, "UNDER"),
    ]


def one(spark, expression, **values):
    literals = [F.lit(v[0]).cast(v[1]).alias(k) if isinstance(v, tuple) else F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals).select(expression).first()[0]


def test_multi_device(spark):
    def raw(used, limit, watch=0, tablet=0):
        return one(spark, scores.multi_device_raw(), sharing_used_gb=(used, "double"), sharing_limit_gb=(limit, "double"), watch_flag=watch, tablet_flag=tablet)

    assert raw(30, 20) == 1
    assert raw(30, 0) == 0
    assert raw(5, 20) == 0.25
    assert raw(None, None, watch=1, tablet=1) == 2


def test_stability(spark):
    def raw(membership, satisfaction, paid):
        values = {"membership": (membership, "string"), "avg_monthly_satisfaction": (satisfaction, "double"), "is_paid": (paid, "boolean")}
        return one(spark, scores.stability_raw(), **values)

    assert raw("VVIP", 5.0, True) == 100
    assert raw(None, None, False) == 0
    assert raw("BASIC", None, None) == pytest.approx(40 / 3)
    assert raw("OTHER", 2.5, True) == 50


def test_segment(spark):
    def decide(tier=None, pattern=None, tags=0, **tscores):
        columns = {code: F.lit(tscores.get(code)).cast("double") for code in scores.UPSELL_TSCORES}
        return one(spark, scores.segment(F.lit(tier), F.lit(pattern), F.lit(tags), columns), x=1)

    assert decide("HIGH", "OVER") == "CHURN_RISK"
    assert decide("LOW", "OVER") == "UPSELL"
    assert decide(tags=2) == "UPSELL"
    assert decide(tags=1) == "NORMAL"
    assert decide(benefit_trend=55.0) == "UPSELL"
    assert decide(explore=54.999) == "NORMAL"
    assert decide(multi_device=59.9, family_home=59.9) == "NORMAL"
    assert decide(family_home=60.0) == "UPSELL"
    assert decide() == "NORMAL"


def test_persona_code(spark):
    codes = column(spark, [*scores.INDEX_CODES, "unknown"], "string", scores.persona_code)
    assert codes == [*scores.PERSONA_BY_INDEX.values(), "SPACE_SHERLOCK"]
