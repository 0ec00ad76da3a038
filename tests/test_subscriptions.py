"""Subscription operators on hand-made rows."""

import json
from datetime import date, timedelta

import pytest

from memberlytics.operators import subscriptions as subs
from memberlytics.schemas import SCHEMAS

AS_OF = date(2024, 1, 30)
DAY = timedelta(days=1)


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


@pytest.fixture(scope="module")
def product(spark):
    return frame(
        spark,
        "product",
        [
            (1, "Plan", "MOBILE_PLAN"), (2, "Plan B", "MOBILE_PLAN"), (3, "Net", "INTERNET"), (4, "TV", "IPTV"),
            (5, "X Watch", "TAB_WATCH_PLAN"), (6, "WEARABLE kit", "TAB_WATCH_PLAN"), (7, "Tab S", "TAB_WATCH_PLAN"),
            (8, None, "TAB_WATCH_PLAN"), (9, "Safe", "ADDON"), (10, "Music", "ADDON"), (11, "No details", "MOBILE_PLAN"),
        ],
    )


@pytest.fixture(scope="module")
def mobile_plan(spark):
    return frame(spark, "mobile_plan", [(1, "12GB", "base 55GB"), (2, "12.5GB", "5.5GB")])


def held(spark, *pairs, start=AS_OF - 100 * DAY, end=None, contract=None):
    rows = [(i, member, product, True, start, end, contract) for i, (member, product) in enumerate(pairs, 1)]
    return frame(spark, "subscription", rows)


def by_member(df):
    return {r.member_id: tuple(r)[1:] for r in df.collect()}


def test_boundary_days_are_active(spark, product):
    rows = [
        (1, 1, 1, True, AS_OF, None, None),
        (2, 1, 1, True, AS_OF - DAY, AS_OF, None),
        (3, 1, 1, True, AS_OF - 9 * DAY, AS_OF - DAY, None),
        (4, 1, 1, False, AS_OF - DAY, None, None),
        (5, 1, 1, True, AS_OF + DAY, None, None),
        (6, 1, 99, True, AS_OF, None, None),
        (7, 1, 1, None, AS_OF, None, None),
    ]
    active = subs.active_subscriptions(frame(spark, "subscription", rows), product, AS_OF)
    assert sorted(r.subscription_id for r in active.collect()) == [1, 2]


def test_watch_and_tablet(spark, product):
    active = subs.active_subscriptions(held(spark, (1, 5), (2, 6), (3, 7), (4, 8), (5, 5), (5, 7), (6, 1)), product, AS_OF)
    flags = by_member(subs.watch_tablet_features(active))
    assert flags == {1: (1, 0), 2: (1, 0), 3: (0, 1), 4: (0, 0), 5: (1, 1), 6: (0, 0)}


def test_internet_and_bundle(spark, product):
    active = subs.active_subscriptions(held(spark, (1, 3), (2, 4), (3, 3), (3, 4), (4, 1)), product, AS_OF)
    assert by_member(subs.internet_iptv_features(active)) == {1: (1, 0), 2: (0, 0), 3: (1, 1), 4: (0, 0)}


def test_addons(spark, product):
    addons = frame(spark, "addon_service", [(9, "SECURITY"), (10, "MEDIA")])
    active = subs.active_subscriptions(held(spark, (1, 9), (1, 10), (1, 9), (2, 10), (3, 1)), product, AS_OF)
    assert by_member(subs.addon_features(active, addons)) == {1: (2, 3), 2: (0, 1)}


def test_sharing_limit_guards(spark, product, mobile_plan):
    active = subs.active_subscriptions(held(spark, (1, 1), (2, 2), (3, 1), (3, 2), (4, 11)), product, AS_OF)
    assert by_member(subs.sharing_limit(active, mobile_plan)) == {1: (55.0,), 2: (0.0,), 3: (55.0,)}
    loose = subs.sharing_limit(active, mobile_plan, strict_integer_guard=False)
    assert by_member(loose) == {1: (55.0,), 2: (5.5,), 3: (55.0,)}


def test_sharing_used(spark, product):
    active = subs.active_subscriptions(held(spark, (1, 1), (1, 2), (2, 1), (3, 3), (4, 1)), product, AS_OF)
    usage = frame(
        spark,
        "usage_monthly",
        [
            (1, "202312", '{"tethering_sharing_data_gb":"12"}'), (2, "202312", '{"tethering_sharing_data_gb":3}'),
            (3, "202312", '{"tethering_sharing_data_gb":"1.5"}'), (4, "202312", '{"tethering_sharing_data_gb":"9"}'),
            (5, "202401", '{"tethering_sharing_data_gb":"9"}'),
        ],
    )
    assert by_member(subs.sharing_used(active, usage, "202312")) == {1: (15.0,), 2: (0.0,)}
    assert by_member(subs.sharing_used(active, usage, "202312", strict_integer_guard=False))[2] == (1.5,)


def test_rollup_equals_separate_operators(spark, product, mobile_plan):
    addons = frame(spark, "addon_service", [(9, "SECURITY"), (10, "MEDIA")])
    subscription = held(spark, *[(m, 1 + (m * 7 + k * k) % 11) for m in range(40) for k in range(5)])
    active = subs.active_subscriptions(subscription, product, AS_OF)
    catalog = subs.product_catalog(product, mobile_plan, addons)
    rolled = {r.member_id: r.asDict() for r in subs.index_rollup(subs.catalogued_subscriptions(subscription, catalog, AS_OF)).collect()}
    parts = [
        subs.addon_features(active, addons),
        subs.internet_iptv_features(active),
        subs.watch_tablet_features(active),
        subs.sharing_limit(active, mobile_plan),
    ]
    for part in parts:
        for row in part.collect():
            for name, value in row.asDict().items():
                assert rolled[row.member_id][name] == value


def test_current_subscriptions_are_ordered_and_keep_nulls(spark, product):
    rows = [
        (3, 1, 8, True, date(2023, 5, 1), None, None),
        (2, 1, 3, True, date(2023, 5, 1), None, None),
        (9, 1, 1, True, date(2022, 1, 2), None, None),
    ]
    active = subs.active_subscriptions(frame(spark, "subscription", rows), product, AS_OF)
    (text,) = by_member(subs.current_subscriptions(active))[1]
    assert json.loads(text) == [
        {"product_id": 1, "product_name": "Plan", "product_type": "MOBILE_PLAN", "start_date": "2022-01-02"},
        {"product_id": 3, "product_name": "Net", "product_type": "INTERNET", "start_date": "2023-05-01"},
        {"product_id": 8, "product_name": None, "product_type": "TAB_WATCH_PLAN", "start_date": "2023-05-01"},
    ]


def test_current_product_types_have_all_keys(spark, product):
    active = subs.active_subscriptions(held(spark, (1, 3), (1, 9)), product, AS_OF)
    (text,) = by_member(subs.current_product_types(active))[1]
    assert json.loads(text) == {"MOBILE_PLAN": False, "INTERNET": True, "IPTV": False, "TAB_WATCH_PLAN": False, "ADDON": True}


@pytest.mark.parametrize(
    "product_id,end,expected",
    [(1, AS_OF, True), (1, date(2024, 4, 29), True), (1, date(2024, 4, 30), False), (9, AS_OF, False), (1, None, False), (1, AS_OF - DAY, False)],
)
def test_contract_expiry(spark, product, product_id, end, expected):
    active = subs.active_subscriptions(held(spark, (1, product_id), contract=end), product, AS_OF)
    assert by_member(subs.contract_flags(active, AS_OF)) == {1: (expected,)}


def test_first_mobile_plan(spark, product, mobile_plan):
    rows = [
        (5, 1, 1, True, date(2023, 1, 1), None, None),
        (4, 1, 2, True, date(2023, 1, 1), None, None),
        (1, 1, 11, True, date(2020, 1, 1), None, None),
        (2, 1, 3, True, date(2020, 1, 1), None, None),
        (6, 2, 11, True, date(2023, 1, 1), None, None),
    ]
    subscription = frame(spark, "subscription", rows)
    expected = {1: (4, date(2023, 1, 1), "12.5GB")}
    active = subs.active_subscriptions(subscription, product, AS_OF)
    assert by_member(subs.mobile_plan_subscription(active, mobile_plan)) == expected
    catalogued = subs.catalogued_subscriptions(subscription, subs.product_catalog(product, mobile_plan), AS_OF)
    rolled = subs.profile_rollup(catalogued, AS_OF)
    assert by_member(rolled.select("member_id", "subscription_id", "start_date", "data_amount")) == expected
    assert len(json.loads(rolled.first().current_subscriptions)) == 4
