"""One Spark query per operator. Each reads whole tables; a limit appears only where it is the
operator's own (chunk sizes, top-k). Doubles are rounded to six places for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import AS_OF, FEATURE_DATES, INDEX_DATES, NOW, PARAMS, table, tables
from memberlytics.functions import scores, sql
from memberlytics.operators import (
    activity,
    dispatch,
    events,
    index,
    members,
    merging,
    profile,
    quality,
    subscriptions,
)
from memberlytics.params import RunParams, previous_month
from memberlytics.plans.dispatch import ANALYSES, OUTBOX, run_dispatch, run_stored_dispatch
from memberlytics.plans.event_features import run_event_features, store_event_features
from memberlytics.plans.weekly_index import run_weekly_index
from memberlytics.schemas import SCHEMAS
from memberlytics.sources import event_logs, features_csv, messages, versions
from memberlytics.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VERSION, JOB, TOKEN = 1, 7, 900
CHUNK = 1000
CLAIM = dispatch.ClaimParams(VERSION, JOB, TOKEN, NOW, CHUNK)
INDEX_TABLES = [
    "member", "product", "subscription", "addon_service", "mobile_plan", "usage_monthly", "member_coupon",
    "support_case", "billing", "persona_type",
]
CONTEXT_TABLES = ["member", "product", "subscription", "mobile_plan", "usage_monthly", "support_case", "churn_score_snapshot"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select([F.round(c, places).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


# -- inputs -------------------------------------------------------------------------------------


def scanned_events(spark: SparkSession, sf_dir: str, as_of: date = AS_OF) -> DataFrame:
    return event_logs.in_scan_window(table(spark, sf_dir, "event_log"), as_of)


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "subscription", "product")
    return subscriptions.active_subscriptions(t["subscription"], t["product"], AS_OF)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event features of this snapshot date, built on the fly."""
    return events.build_event_features(scanned_events(spark, sf_dir), AS_OF, ordered=False)


def index_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {**tables(spark, sf_dir, *INDEX_TABLES), "user_event_features_7d": features(spark, sf_dir)}


_stores: dict[tuple[str, str], str] = {}


def chained(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Snapshots the jobs have stored: features of three dates, indices of the last two. They are
    built once per session and data set, as queries on stored snapshots would find them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = f"{versions.shared_folder(spark)}/store-{uuid.uuid4().hex}"
        log = table(spark, sf_dir, "event_log")
        for day in FEATURE_DATES:
            store_event_features(event_logs.in_scan_window(log, day), store, RunParams(day, previous_month(day)))
        inputs = tables(spark, sf_dir, *INDEX_TABLES)
        inputs["user_event_features_7d"] = _snapshots(spark, store, "user_event_features_7d")
        for day in INDEX_DATES:
            run_weekly_index(inputs, store, RunParams(day, previous_month(day)))
        _stores[key] = store
    names = ["user_event_features_7d", "index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot"]
    return {name: _snapshots(spark, _stores[key], name) for name in names}


def _snapshots(spark: SparkSession, store: str, name: str) -> DataFrame:
    return versions.read_snapshots(spark, f"{store}/{name}", SCHEMAS[name])


def context(spark: SparkSession, sf_dir: str, as_of: date = AS_OF, store_plans: bool = True) -> DataFrame:
    inputs = {**tables(spark, sf_dir, *CONTEXT_TABLES), **chained(spark, sf_dir)}
    return profile.build_member_context(inputs, RunParams(as_of, previous_month(as_of)), NOW, store_plans=store_plans)


def mobile_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscriptions.mobile_plan_subscription(active(spark, sf_dir), table(spark, sf_dir, "mobile_plan"))


# -- event features -----------------------------------------------------------------------------


@query
def p1_event_counts(spark, sf_dir):
    return events.event_counts(scanned_events(spark, sf_dir), AS_OF)


@query
def p1_product_type_clicks(spark, sf_dir):
    return events.product_type_clicks(scanned_events(spark, sf_dir), AS_OF)


@query
def p1_tag_counts(spark, sf_dir):
    return events.tag_counts(scanned_events(spark, sf_dir), AS_OF)


@query
def p1_top_tags(spark, sf_dir):
    return events.top_tags(events.tag_counts(scanned_events(spark, sf_dir), AS_OF))


@query
def p1_event_features(spark, sf_dir):
    return events.build_event_features(scanned_events(spark, sf_dir), AS_OF)


@query
def p1_event_features_incremental(spark, sf_dir):
    """The same from stored sums per arrival day, for one snapshot date after the other, the log growing in between."""
    folder = f"{versions.shared_folder(spark)}/incremental-{uuid.uuid4().hex}"
    path, store, log = f"{folder}/log", f"{folder}/store", table(spark, sf_dir, "event_log")
    arrived, before = F.col("dt").cast("date"), None
    for day in FEATURE_DATES:
        new = log.where(arrived <= F.lit(day))
        new = new.where(arrived > F.lit(before)) if before else new
        new.repartitionByRange("dt", "timestamp").write.mode("append").partitionBy("dt").parquet(path)
        stored = run_event_features(spark, path, store, RunParams(day, previous_month(day)), incremental=True)
        before = day
    return stored.orderBy("member_id")


# -- index inputs -------------------------------------------------------------------------------


@query
def active_subscriptions(spark, sf_dir):
    return active(spark, sf_dir)


@query
def base_members(spark, sf_dir):
    return members.base_members(table(spark, sf_dir, "member"))


@query
def family_counts(spark, sf_dir):
    return members.family_counts(table(spark, sf_dir, "member"))


@query
def family_size(spark, sf_dir):
    member = table(spark, sf_dir, "member")
    sized = members.with_family_size(members.base_members(member), members.family_counts(member))
    return sized.select("member_id", "family_group_id", F.coalesce("family_member_cnt", F.lit(0)).alias("family_member_cnt"))


@query
def addon_features(spark, sf_dir):
    return subscriptions.addon_features(active(spark, sf_dir), table(spark, sf_dir, "addon_service"))


@query
def internet_iptv_features(spark, sf_dir):
    return subscriptions.internet_iptv_features(active(spark, sf_dir))


@query
def watch_tablet_features(spark, sf_dir):
    return subscriptions.watch_tablet_features(active(spark, sf_dir))


@query
def sharing_limit(spark, sf_dir):
    return subscriptions.sharing_limit(active(spark, sf_dir), table(spark, sf_dir, "mobile_plan"))


@query
def sharing_limit_decimals(spark, sf_dir):
    return subscriptions.sharing_limit(active(spark, sf_dir), table(spark, sf_dir, "mobile_plan"), False)


@query
def sharing_used(spark, sf_dir):
    return subscriptions.sharing_used(active(spark, sf_dir), table(spark, sf_dir, "usage_monthly"), PARAMS.yyyymm)


@query
def sharing_used_decimals(spark, sf_dir):
    usage = table(spark, sf_dir, "usage_monthly")
    return subscriptions.sharing_used(active(spark, sf_dir), usage, PARAMS.yyyymm, strict_integer_guard=False)


@query
def index_rollup(spark, sf_dir):
    t = tables(spark, sf_dir, "product", "mobile_plan", "addon_service", "subscription")
    catalog = subscriptions.product_catalog(t["product"], t["mobile_plan"], t["addon_service"])
    return subscriptions.index_rollup(subscriptions.catalogued_subscriptions(t["subscription"], catalog, AS_OF))


@query
def coupon_7d(spark, sf_dir):
    return activity.coupon_7d(table(spark, sf_dir, "member_coupon"), AS_OF)


@query
def support_monthly(spark, sf_dir):
    return rounded(activity.support_monthly(table(spark, sf_dir, "support_case"), PARAMS.yyyymm))


@query
def billing_monthly(spark, sf_dir):
    return activity.billing_monthly(table(spark, sf_dir, "billing"), PARAMS.yyyymm)


@query
def log_features(spark, sf_dir):
    return activity.log_features(features(spark, sf_dir), AS_OF)


# -- index --------------------------------------------------------------------------------------


@query
def raw_snapshot(spark, sf_dir):
    return rounded(index.build_raw_snapshot(index_inputs(spark, sf_dir), PARAMS))


def _raw_score(code: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = index.index_features(index_inputs(spark, sf_dir), PARAMS)
        return rounded(rows.select("member_id", scores.RAW_SCORES[code]().alias(f"{code}_raw")))

    return run


for _code in scores.INDEX_CODES:
    QUERIES[f"{_code}_raw"] = _raw_score(_code)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chained(spark, sf_dir)["index_raw_snapshot"]


def _tscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_tscore_snapshot(_raw(spark, sf_dir), AS_OF)


@query
def index_stats(spark, sf_dir):
    return rounded(index.index_stats(_raw(spark, sf_dir).where(F.col("snapshot_date") == F.lit(AS_OF))))


@query
def tscore_snapshot(spark, sf_dir):
    return rounded(_tscores(spark, sf_dir))


@query
def unpivot_scores(spark, sf_dir):
    return rounded(index.unpivot_scores(_tscores(spark, sf_dir)))


@query
def winning_index(spark, sf_dir):
    return rounded(index.winning_index(_tscores(spark, sf_dir)))


@query
def persona_code(spark, sf_dir):
    codes = index.unpivot_scores(_tscores(spark, sf_dir)).select("member_id", "index_code")
    return codes.withColumn("persona_code", scores.persona_code(F.col("index_code")))


@query
def latest_persona_type(spark, sf_dir):
    return index.latest_persona_type(table(spark, sf_dir, "persona_type"))


@query
def persona_snapshot(spark, sf_dir):
    return rounded(index.build_persona_snapshot(_tscores(spark, sf_dir), table(spark, sf_dir, "persona_type"), AS_OF))


# -- profile ------------------------------------------------------------------------------------


@query
def mobile_plan_subscription(spark, sf_dir):
    return mobile_plans(spark, sf_dir)


@query
def latest_persona(spark, sf_dir):
    return activity.latest_persona(chained(spark, sf_dir)["index_persona_snapshot"])


@query
def latest_tscore(spark, sf_dir):
    return rounded(activity.latest_tscore(chained(spark, sf_dir)["index_tscore_snapshot"]))


@query
def latest_churn(spark, sf_dir):
    return activity.latest_churn(table(spark, sf_dir, "churn_score_snapshot"))


@query
def latest_churn_bounded(spark, sf_dir):
    return activity.latest_churn(table(spark, sf_dir, "churn_score_snapshot"), up_to=AS_OF)


@query
def latest_logs(spark, sf_dir):
    return activity.latest_logs(chained(spark, sf_dir)["user_event_features_7d"], AS_OF)


@query
def current_subscriptions(spark, sf_dir):
    return subscriptions.current_subscriptions(active(spark, sf_dir))


@query
def current_product_types(spark, sf_dir):
    return subscriptions.current_product_types(active(spark, sf_dir))


@query
def recent_counseling(spark, sf_dir):
    return activity.recent_counseling(table(spark, sf_dir, "support_case"))


@query
def usage_metrics(spark, sf_dir):
    usage = profile.usage_metrics(mobile_plans(spark, sf_dir), table(spark, sf_dir, "usage_monthly"), PARAMS.yyyymm)
    return rounded(usage.withColumn("usage_ratio", F.col("usage_ratio").cast("double")))


@query
def contract_flags(spark, sf_dir):
    return subscriptions.contract_flags(active(spark, sf_dir), AS_OF)


@query
def age_and_tenure(spark, sf_dir):
    return profile.age_and_tenure(table(spark, sf_dir, "member"), mobile_plans(spark, sf_dir), AS_OF)


@query
def upsell_tag_count(spark, sf_dir):
    return profile.upsell_tag_count(features(spark, sf_dir))


@query
def segment(spark, sf_dir):
    return context(spark, sf_dir, store_plans=False).select("member_id", "segment")


@query
def member_context(spark, sf_dir):
    return context(spark, sf_dir)


@query
def context_upsert(spark, sf_dir):
    """Profiles of the earlier date, then those of the later one merged into them, each stored as the job does."""
    current, built = (versions.materialize(context(spark, sf_dir, day), "context") for day in INDEX_DATES)
    return merging.upsert_by_key(current, built, ["member_id"])


# -- the same in SQL ----------------------------------------------------------------------------


def in_sql(spark: SparkSession, statement: str, **views: DataFrame) -> DataFrame:
    """`statement` over `views`, with the SQL functions registered."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    sql.register(spark)
    return spark.sql(statement)


def _active_in_sql(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    for name, df in tables(spark, sf_dir, "subscription", "product").items():
        df.createOrReplaceTempView(name)
    sql.register_tables(spark)
    return in_sql(spark, statement)


@query
def sql_active_subscriptions(spark, sf_dir):
    return _active_in_sql(spark, sf_dir, f"SELECT * FROM active_subscriptions(DATE '{AS_OF}')")


@query
def sql_contract_flags(spark, sf_dir):
    return _active_in_sql(
        spark,
        sf_dir,
        f"""SELECT member_id, bool_or(product_type <> 'ADDON' AND ends_within_3_months(contract_end_date, DATE '{AS_OF}')) AS contract_expiry_within_3m
        FROM active_subscriptions(DATE '{AS_OF}') GROUP BY member_id""",
    )


@query
def sql_raw_snapshot(spark, sf_dir):
    statement = f"""
        SELECT DATE '{AS_OF}' AS snapshot_date, member_id,
          round(explore_raw(click_product_detail_cnt, click_compare_cnt), 6) AS explore_raw,
          round(benefit_trend_raw(addon_subscribe_cnt, coupon_used_cnt, click_change_success_cnt), 6) AS benefit_trend_raw,
          round(multi_device_raw(watch_flag, tablet_flag, sharing_limit_gb, sharing_used_gb), 6) AS multi_device_raw,
          round(family_home_raw(family_member_cnt, has_internet_iptv_bundle, children_count), 6) AS family_home_raw,
          round(internet_security_raw(internet_flag, security_addon_cnt), 6) AS internet_security_raw,
          round(stability_raw(membership, avg_monthly_satisfaction, is_paid), 6) AS stability_raw
        FROM index_inputs"""
    return in_sql(spark, statement, index_inputs=index.index_features(index_inputs(spark, sf_dir), PARAMS))


@query
def sql_tscore_snapshot(spark, sf_dir):
    raw = _raw(spark, sf_dir).where(F.col("snapshot_date") == F.lit(AS_OF))
    scored = ", ".join(
        f"round(t_score({c}_raw, {c}_mean, {c}_stddev, {c}_min, {c}_max), 6) AS {c}_tscore" for c in scores.INDEX_CODES
    )
    stats = index.index_stats(raw)
    names = ", ".join(f"(SELECT {c}_{what} FROM index_stats) AS {c}_{what}" for c in scores.INDEX_CODES for what in ("mean", "stddev", "min", "max"))
    statement = f"SELECT snapshot_date, member_id, {scored} FROM (SELECT *, {names} FROM raw_scores)"
    return in_sql(spark, statement, raw_scores=raw, index_stats=stats)


@query
def sql_persona_code(spark, sf_dir):
    scored = index.unpivot_scores(_tscores(spark, sf_dir))
    return in_sql(spark, "SELECT member_id, index_code, persona_code(index_code) AS persona_code FROM score_list", score_list=scored)


@query
def sql_usage_metrics(spark, sf_dir):
    statement = f"""
        SELECT member_id, round(CAST(share AS DOUBLE), 6) AS usage_ratio, usage_percent(share) AS current_data_usage_ratio,
          usage_pattern(share) AS data_usage_pattern
        FROM (SELECT member_id, usage_share(allowance_gb(data_amount), used_gb(usage_details)) AS share
          FROM mobile LEFT JOIN (SELECT * FROM usage_monthly WHERE yyyymm = '{PARAMS.yyyymm}') USING (subscription_id))"""
    return in_sql(spark, statement, mobile=mobile_plans(spark, sf_dir), usage_monthly=table(spark, sf_dir, "usage_monthly"))


@query
def sql_age_and_tenure(spark, sf_dir):
    statement = f"""
        SELECT member_id, age_group(birth_date, DATE '{AS_OF}') AS age_group, whole_months(CAST(start_date AS DATE), DATE '{AS_OF}') AS join_months
        FROM member JOIN mobile USING (member_id)"""
    return in_sql(spark, statement, member=table(spark, sf_dir, "member"), mobile=mobile_plans(spark, sf_dir))


@query
def sql_segment(spark, sf_dir):
    tscores = ", ".join(f"{code}_tscore" for code in scores.UPSELL_TSCORES)
    statement = f"""
        SELECT member_id, segment_of(churn_tier, data_usage_pattern, upsell_tag_count(recent_viewed_tags_top_3), {tscores}) AS segment
        FROM profiles LEFT JOIN newest_tscore USING (member_id)"""
    newest = activity.latest_tscore(chained(spark, sf_dir)["index_tscore_snapshot"])
    return in_sql(spark, statement, profiles=context(spark, sf_dir, store_plans=False), newest_tscore=newest)


# -- claim and dispatch -------------------------------------------------------------------------


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = tables(spark, sf_dir, "support_case", "consultation_analysis", "analysis_dispatch_outbox")
    return t["support_case"], t["consultation_analysis"], t["analysis_dispatch_outbox"]


def _deliver(sent: DataFrame) -> DataFrame:
    """A broker that refuses every fourth case, with a long error text."""
    ok = F.get_json_object("value", "$.caseId").cast("bigint") % 4 != 0
    error = F.when(~ok, F.repeat(F.lit("e"), 1200))
    return sent.select(F.col("key").alias("request_id"), ok.alias("ok"), error.alias("error"))


@query
def request_id(spark, sf_dir):
    analyses = table(spark, sf_dir, "consultation_analysis")
    key = dispatch.request_id(F.col("case_id"), F.col("analyzer_version"))
    return analyses.select("analysis_id", key.alias("request_id"))


@query
def seed_analyses(spark, sf_dir):
    cases, analyses, _ = _state(spark, sf_dir)
    return dispatch.seed_analyses(cases, analyses, VERSION, JOB, CHUNK)


@query
def insert_ignore(spark, sf_dir):
    """Every case offered as a new analysis: only those without one are taken."""
    cases, analyses, _ = _state(spark, sf_dir)
    offered = cases.select(
        (F.col("case_id") + 1_000_000_000).alias("analysis_id"),
        "case_id",
        F.lit(VERSION).cast("bigint").alias("analyzer_version"),
        F.lit(JOB).cast("bigint").alias("job_instance_id"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    return merging.insert_ignore(analyses, offered, ["case_id", "analyzer_version"])


@query
def insert_ignore_repeated(spark, sf_dir):
    """The same with every case offered twice: the one with the smaller id is taken."""
    cases, analyses, _ = _state(spark, sf_dir)
    offered = cases.select(
        F.explode(F.array(F.col("case_id") + 2_000_000_000, F.col("case_id") + 1_000_000_000)).alias("analysis_id"),
        "case_id",
        F.lit(VERSION).cast("bigint").alias("analyzer_version"),
        F.lit(JOB).cast("bigint").alias("job_instance_id"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    return merging.insert_ignore(analyses, offered, ["case_id", "analyzer_version"])


@query
def backlog(spark, sf_dir):
    _, analyses, outbox = _state(spark, sf_dir)
    return dispatch.backlog(analyses, outbox, VERSION, NOW, CLAIM.lease_sec)


@query
def pickable(spark, sf_dir):
    _, analyses, outbox = _state(spark, sf_dir)
    return dispatch.pickable(analyses, outbox, VERSION, NOW, CLAIM.lease_sec, CHUNK)


@query
def claim_chunk(spark, sf_dir):
    """The outbox after a claim."""
    return dispatch.claim_chunk(*_state(spark, sf_dir), CLAIM).outbox


@query
def claim_chunk_analyses(spark, sf_dir):
    """The analyses after a claim, seeded ones included."""
    return dispatch.claim_chunk(*_state(spark, sf_dir), CLAIM).analyses


@query
def claimed_targets(spark, sf_dir):
    _, analyses, outbox = _state(spark, sf_dir)
    return dispatch.claimed_targets(analyses, outbox, 3)


@query
def dispatch_messages(spark, sf_dir):
    _, analyses, outbox = _state(spark, sf_dir)
    targets = dispatch.claimed_targets(analyses, outbox, 3)
    return messages.to_request_messages(dispatch.plan_dispatch(targets, outbox, JOB, 3, NOW).to_send)


@query
def message_sink_roundtrip(spark, sf_dir):
    """All analyses delivered to a folder and read back, with the answer to each."""
    _, analyses, _ = _state(spark, sf_dir)
    keyed = analyses.withColumn("request_id", dispatch.request_id(F.col("case_id"), F.col("analyzer_version")))
    folder = f"{versions.shared_folder(spark)}/messages-{uuid.uuid4().hex}"
    answers = messages.deliver_to_folder(folder)(messages.to_request_messages(keyed))
    return messages.read_messages(spark, folder).join(answers.toDF("key", "ok", "error"), "key")


@query
def dispatch_register(spark, sf_dir):
    """Every analysis registered for dispatch: new outbox rows appear, old ones keep their status."""
    _, analyses, outbox = _state(spark, sf_dir)
    key = dispatch.request_id(F.col("case_id"), F.col("analyzer_version"))
    return dispatch.plan_dispatch(analyses.withColumn("request_id", key), outbox, JOB, TOKEN, NOW).outbox


def _all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, analyses, _ = _state(spark, sf_dir)
    key = dispatch.request_id(F.col("case_id"), F.col("analyzer_version"))
    return _deliver(messages.to_request_messages(analyses.withColumn("request_id", key)))


@query
def apply_results(spark, sf_dir):
    _, _, outbox = _state(spark, sf_dir)
    return dispatch.apply_results(outbox, _all_results(spark, sf_dir), NOW)


@query
def apply_results_repeated(spark, sf_dir):
    """Every answer twice, and after a success a failure: a success counts, and no row is doubled."""
    _, _, outbox = _state(spark, sf_dir)
    answers = _all_results(spark, sf_dir)
    late = answers.where("ok").select("request_id", F.lit(False).alias("ok"), F.lit("late").alias("error"))
    return dispatch.apply_results(outbox, answers.unionAll(answers).unionByName(late), NOW)


@query
def dispatch_counts(spark, sf_dir):
    _, analyses, outbox = _state(spark, sf_dir)
    key = dispatch.request_id(F.col("case_id"), F.col("analyzer_version"))
    plan = dispatch.plan_dispatch(analyses.withColumn("request_id", key), outbox, JOB, TOKEN, NOW)
    return dispatch.dispatch_counts(plan, _deliver(messages.to_request_messages(plan.to_send)))


@query
def drain_dispatch(spark, sf_dir):
    """The outbox after claiming and delivering until nothing is left."""
    drained = run_dispatch(*_state(spark, sf_dir), _deliver, VERSION, JOB, NOW, TOKEN, CHUNK)
    return drained.outbox.select(
        "request_id", "dispatch_status", "attempt_count", "next_retry_at", "last_error", "claimed_done_at", "created_at"
    )


@query
def drain_dispatch_resumed(spark, sf_dir):
    """The outbox after a stored drain whose delivery breaks in its second wave, and the start that finishes it."""
    cases, analyses, outbox = _state(spark, sf_dir)
    store = f"{versions.shared_folder(spark)}/drain-{uuid.uuid4().hex}"
    versions.replace_tables({ANALYSES: analyses, OUTBOX: outbox}, store)
    waves = []

    def breaking(sent: DataFrame) -> DataFrame:
        waves.append(sent)
        if len(waves) == 2:
            raise ConnectionError("delivery breaks")
        return _deliver(sent)

    settings = {"version": VERSION, "job": JOB, "now": NOW, "first_token": TOKEN, "chunk": CHUNK, "wave_rounds": 1}
    try:
        drained = run_stored_dispatch(cases, store, breaking, **settings)
    except ConnectionError:
        drained = run_stored_dispatch(cases, store, _deliver, **settings)
    return drained.outbox.select(
        "request_id", "dispatch_status", "attempt_count", "next_retry_at", "last_error", "claimed_done_at", "created_at"
    )


# The same operators where the outbox holds rows of another type and there is a second analyzer version.


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    names = ["support_case", "consultation_analysis_mixed", "analysis_dispatch_outbox_mixed"]
    cases, analyses, outbox = tables(spark, sf_dir, *names).values()
    return cases, analyses, outbox


@query
def backlog_mixed(spark, sf_dir):
    _, analyses, outbox = _mixed(spark, sf_dir)
    return dispatch.backlog(analyses, outbox, VERSION, NOW, CLAIM.lease_sec)


@query
def backlog_second_version(spark, sf_dir):
    _, analyses, outbox = _mixed(spark, sf_dir)
    return dispatch.backlog(analyses, outbox, 2, NOW, CLAIM.lease_sec)


@query
def claim_chunk_mixed(spark, sf_dir):
    return dispatch.claim_chunk(*_mixed(spark, sf_dir), CLAIM).outbox


@query
def claimed_targets_mixed(spark, sf_dir):
    _, analyses, outbox = _mixed(spark, sf_dir)
    return dispatch.claimed_targets(analyses, outbox, 3)


@query
def apply_results_unanswered(spark, sf_dir):
    """Two of three cases are answered, and rows of another type stay as they are."""
    _, analyses, outbox = _mixed(spark, sf_dir)
    answered = analyses.where("analyzer_version = 1 AND case_id % 3 <> 0")
    key = dispatch.request_id(F.col("case_id"), F.col("analyzer_version"))
    results = _deliver(messages.to_request_messages(answered.withColumn("request_id", key)))
    return dispatch.apply_results(outbox, results, NOW)


@query
def drain_dispatch_mixed(spark, sf_dir):
    drained = run_dispatch(*_mixed(spark, sf_dir), _deliver, VERSION, JOB, NOW, TOKEN, CHUNK)
    return drained.outbox.select(
        "request_id", "dispatch_status", "attempt_count", "next_retry_at", "last_error", "claimed_done_at", "created_at", "type"
    )


# -- checks and sinks ---------------------------------------------------------------------------


@query
def index_counts(spark, sf_dir):
    t = chained(spark, sf_dir)
    return quality.check_index_counts(
        table(spark, sf_dir, "member"),
        t["index_raw_snapshot"],
        t["index_tscore_snapshot"],
        t["index_persona_snapshot"],
        AS_OF,
    )


@query
def tscore_nulls(spark, sf_dir):
    return quality.check_nulls(chained(spark, sf_dir)["index_tscore_snapshot"], quality.TSCORE_COLUMNS, AS_OF)


@query
def persona_nulls(spark, sf_dir):
    return quality.check_nulls(chained(spark, sf_dir)["index_persona_snapshot"], quality.PERSONA_COLUMNS, AS_OF)


@query
def features_count(spark, sf_dir):
    return quality.check_not_empty(features(spark, sf_dir), AS_OF)


@query
def usage_amounts_check(spark, sf_dir):
    return quality.check_usage_amounts(table(spark, sf_dir, "usage_monthly"), PARAMS.yyyymm)


@query
def context_check(spark, sf_dir):
    t = tables(spark, sf_dir, "subscription", "product")
    built = versions.materialize(context(spark, sf_dir), "context")
    return quality.check_member_context(t["subscription"], t["product"], built, built)


@query
def snapshot_replace(spark, sf_dir):
    """Features stored twice for one date and once for another, read back."""
    root = f"{versions.shared_folder(spark)}/replace-{uuid.uuid4().hex}"
    for day in [AS_OF, FEATURE_DATES[1], AS_OF]:
        built = events.build_event_features(scanned_events(spark, sf_dir, day), day, ordered=False)
        versions.replace_snapshot(built, root, day)
    return versions.read_snapshots(spark, root, SCHEMAS["user_event_features_7d"])


@query
def features_csv_roundtrip(spark, sf_dir):
    path = f"{versions.shared_folder(spark)}/features-{uuid.uuid4().hex}.csv"
    features_csv.write_features_csv(features(spark, sf_dir), path)
    return features_csv.read_features_csv(spark, path)


@query
def table_read(spark, sf_dir):
    """A stored table read under its fixed schema."""
    root = f"{versions.shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    table(spark, sf_dir, "subscription").write.parquet(f"{root}/subscription")
    return read_table(spark, root, "subscription")


@query
def pruned_event_scan(spark, sf_dir):
    """The event log written by arrival day, then scanned for the window of the snapshot date."""
    path = f"{versions.shared_folder(spark)}/events-{uuid.uuid4().hex}"
    # By range, so that a busy day is written by several tasks and a task writes few days.
    log = table(spark, sf_dir, "event_log").repartitionByRange("dt", "timestamp")
    log.write.partitionBy("dt").parquet(path)
    scanned = event_logs.scan_event_logs(spark, path, AS_OF)
    return scanned.select(
        "member_id",
        "event_name",
        "timestamp",
        F.col("event_properties.product_type").alias("product_type"),
        F.to_json("event_properties.tags").alias("tags"),
        "dt",
    )
