"""Physical plans and skew: what must hold for the operators to run on a large cluster."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import AS_OF, NOW
from checks.queries import QUERIES
from checks.staging import EVENT_LOG, stage, staged
from memberlytics.operators import activity, dispatch, events, index, lookups, profile, subscriptions
from memberlytics.params import RunParams
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.event_logs import day_signs, scan_event_days, scan_event_logs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"FileScan parquet .*", plan)


@pytest.fixture(scope="module")
def root(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("scale"))
    stage(spark, sf_dir, root)
    return root


def test_event_features_read_the_log_once(spark, root):
    plan = plan_of(events.build_event_features(scan_event_logs(spark, f"{root}/{EVENT_LOG}", AS_OF), AS_OF, ordered=False))
    found = scans(plan)
    assert len(found) == 1 and "PartitionFilters: [isnotnull(dt" in found[0]
    # Sums per member, kind and value, then one partitioning by member for ranks and features.
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan and "rangepartitioning" not in plan


def test_partials_open_changed_days_only(spark, root):
    """Listing a log does not open its files, and reading some days opens no other."""
    log = f"{root}/{EVENT_LOG}"
    plan = plan_of(events.daily_partials(scan_event_days(spark, log, [AS_OF])))
    assert len(scans(plan)) == 1 and "PartitionFilters: [isnotnull(dt" in scans(plan)[0] and "2024-01-30" in scans(plan)[0]
    signs = day_signs(spark, log, AS_OF)
    assert signs == day_signs(spark, log, AS_OF) and AS_OF in signs and len(signs) <= 90


def test_filters_reach_the_scans(spark, root):
    t = staged(spark, root)
    coupon = scans(plan_of(activity.coupon_7d(t["member_coupon"], AS_OF)))[0]
    assert "GreaterThanOrEqual(used_at" in coupon and "coupon_id" not in coupon.split("ReadSchema")[1]
    support = scans(plan_of(activity.support_monthly(t["support_case"], "202312")))[0]
    assert "resolved_at" in support.split("PushedFilters")[1] and "title" not in support.split("ReadSchema")[1]
    billing = scans(plan_of(activity.billing_monthly(t["billing"], "202312")))[0]
    assert "EqualTo(yyyymm,202312)" in billing


def test_latest_rows_are_cut_before_the_shuffle(spark, root):
    t = staged(spark, root)
    for df in [activity.latest_churn(t["churn_score_snapshot"]), activity.recent_counseling(t["support_case"])]:
        plan = plan_of(df)
        assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_winner_needs_no_shuffle(spark):
    tscores = spark.createDataFrame([(AS_OF, 1, *[50.0] * 6)], SCHEMAS["index_tscore_snapshot"])
    assert "Exchange" not in plan_of(index.winning_index(tscores))


def test_claims_are_top_n_not_sorts(spark, root):
    t = staged(spark, root)
    plan = plan_of(dispatch.pickable(t["consultation_analysis"], t["analysis_dispatch_outbox"], 1, NOW, 1800, 1000))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_features_of_one_member_meet_in_one_partitioning(spark, root):
    """Without broadcasts, the population and each feature are shuffled by member once."""
    t = staged(spark, root)
    log = scan_event_logs(spark, f"{root}/{EVENT_LOG}", AS_OF)
    t["user_event_features_7d"] = events.build_event_features(log, AS_OF, ordered=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(index.build_raw_snapshot(t, RunParams(AS_OF, "202312")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # population, rollup, usage, coupons, ratings, bills, log features (two)
    by_member = re.findall(r"Exchange hashpartitioning\(member_id#\d+L, 4\)", plan)
    assert len(by_member) <= 9


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_lookup_with_hot_and_null_keys(spark, how):
    keys = spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 4000).cast("bigint").alias("k"),
    )
    lookup = spark.range(3500).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.when(F.col("id") != 1, 1).alias("w"))
    joined = lookups.join_lookup(keys, lookup, "k", how, spread_by="id", max_bytes=0)
    plain = keys.join(lookup, "k", how).select(joined.columns)
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    assert joined.count() == plain.count()


def test_hot_rows_are_spread(spark):
    """A key with a third of the rows and a third without key end up evenly spread."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 2, F.col("id")).cast("bigint").alias("k"))
        lookup = spark.range(30000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        hot = lookup.where(F.col("k") == 1)
        joined = lookups.join_hot_apart(rows, lookup, hot, "k", "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30000 and max(sizes) < 1.2 * 30000 / 4


def test_hot_keys_are_few(spark):
    rows = spark.range(10000).select(F.when(F.col("id") < 4000, 7).when(F.col("id") < 4020, 8).otherwise(F.col("id")).alias("k"))
    assert sorted(r.k for r in lookups.hot_keys(rows, "k").collect()) == [7, 8]


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a bigint, b string")
    assert lookups.measured_bytes(df) == 2 * 32 + 3
    assert lookups.measured_bytes(df.limit(0)) == 0


def test_snapshot_date_is_a_literal(spark, root):
    counts = events.event_counts(scan_event_logs(spark, f"{root}/{EVENT_LOG}", date(2024, 1, 16)), date(2024, 1, 16))
    assert {r.snapshot_date for r in counts.collect()} == {date(2024, 1, 16)}


def test_subscriptions_are_built_once_by_tasks_of_bounded_size(spark, sf_dir, tmp_path, monkeypatch):
    """More line items make more tasks, not larger ones, and what is built is read again by later queries."""
    data = tmp_path / "data"
    data.mkdir()
    for name in inputs.DRIVER_TABLES:
        (data / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    expected = inputs.table(spark, sf_dir, "subscription")
    many = 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(inputs, "TASK_ROWS", -(-inputs.table(spark, sf_dir, "lineitem").count() // many))
    built = inputs.table(spark, str(data), "subscription")
    assert len(built.inputFiles()) == many
    assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))
    again = inputs.table(spark, str(data), "usage_monthly")
    assert set(again.inputFiles()) == set(built.inputFiles())


def test_profile_goes_through_subscriptions_once(spark, root):
    """Rows and usage share the stored plans, and the joins of the features run in a stage without that aggregate."""
    t = staged(spark, root)
    t["user_event_features_7d"] = spark.createDataFrame([], SCHEMAS["user_event_features_7d"])
    for name in ("index_persona_snapshot", "index_tscore_snapshot"):
        t[name] = spark.createDataFrame([], SCHEMAS[name])
    found = scans(plan_of(profile.build_member_context(t, RunParams(AS_OF, "202312"), NOW, store_plans=True)))
    assert not [scan for scan in found if f"{root}/subscription" in scan]
    assert len([scan for scan in found if "profile-plans" in scan]) == 2


def test_merged_profiles_are_stored_first(spark, sf_dir):
    """The merge of two dates is one join of stored profiles: no stage holds the operators of several profiles."""
    plan = plan_of(QUERIES["context_upsert"](spark, sf_dir))
    assert plan.count("Join") == 1 and "LeftAnti" in plan and "Window" not in plan


def test_many_documents_and_rows_meet_hashed_plans(spark):
    """Joins by subscription and by product sort no side: the smaller one, with a row per key, is hashed."""
    plans = spark.createDataFrame([(1, 10, "MOBILE_PLAN", "5GB"), (2, 20, "MOBILE_PLAN", "6GB"), (3, 30, "IPTV", None), (4, None, "MOBILE_PLAN", "6GB")], "member_id bigint, subscription_id bigint, product_type string, data_amount string")
    text = """'{"data_gb": 3, "tethering_sharing_data_gb": "2"}' AS usage_details"""
    usage = spark.range(100).selectExpr("CASE WHEN id < 99 THEN id END AS subscription_id", "'202312' AS yyyymm", text)
    used = profile.usage_metrics(plans, usage, "202312")
    shared = subscriptions.sharing_used(plans, usage, "202312")
    served = lookups.join_lookup(usage, plans.select("subscription_id", "data_amount").where("subscription_id IS NOT NULL"), "subscription_id", "left", spread_by="yyyymm", max_bytes=0)
    for df in (used, shared, served):
        plan = plan_of(df)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r.member_id, r.current_data_usage_ratio) for r in used.collect()) == [(1, 60), (2, 50), (3, None), (4, None)]
    assert sorted(map(tuple, shared.collect())) == [(1, 2.0), (2, 2.0)]
    assert served.count() == 100 and served.where("data_amount IS NOT NULL").count() == 2
