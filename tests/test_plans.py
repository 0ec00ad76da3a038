"""The jobs end to end on stored tables: repeatable, and consistent with each other."""

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF, FEATURE_DATES, INDEX_DATES, NOW
from checks.staging import EVENT_LOG, stage, staged
from memberlytics.functions.scores import INDEX_CODES, SEGMENTS
from memberlytics.operators.merging import DuplicateKeys, duplicate_keys
from memberlytics.operators.quality import CheckFailed
from memberlytics.params import RunParams, previous_month
from memberlytics.plans import jobs
from memberlytics.plans.event_features import run_event_features
from memberlytics.plans.member_context import run_member_context
from memberlytics.plans.weekly_index import run_weekly_index
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.messages import deliver_to_folder, read_messages
from memberlytics.sources.tables import MissingTables
from memberlytics.sources.versions import read_replaced, read_snapshots


def run_of(day):
    return RunParams(day, previous_month(day))


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def world(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    root, store = str(base / "tables"), str(base / "store")
    stage(spark, sf_dir, root)
    for day in FEATURE_DATES:
        run_event_features(spark, f"{root}/{EVENT_LOG}", store, run_of(day))
    tables = staged(spark, root)
    tables["user_event_features_7d"] = read_snapshots(spark, f"{store}/user_event_features_7d", SCHEMAS["user_event_features_7d"])
    for day in INDEX_DATES:
        run_weekly_index(tables, store, run_of(day))
    for name in ["index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot"]:
        tables[name] = read_snapshots(spark, f"{store}/{name}", SCHEMAS[name])
    return root, store, tables


def test_features_rerun_is_the_same(spark, world):
    root, store, tables = world
    before = rows_of(tables["user_event_features_7d"])
    run_event_features(spark, f"{root}/{EVENT_LOG}", store, run_of(AS_OF))
    after = read_snapshots(spark, f"{store}/user_event_features_7d", SCHEMAS["user_event_features_7d"])
    assert rows_of(after) == before


def test_index_rerun_is_the_same(spark, world):
    _, store, tables = world
    before = {name: rows_of(tables[name]) for name in tables if name.startswith("index_")}
    run_weekly_index(tables, store, run_of(AS_OF))
    for name, rows in before.items():
        assert rows_of(read_snapshots(spark, f"{store}/{name}", SCHEMAS[name])) == rows


def test_index_properties(world):
    _, _, tables = world
    for name in ["index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot"]:
        assert duplicate_keys(tables[name], ["snapshot_date", "member_id"]).count() == 0
        assert tables[name].where(F.col("snapshot_date") == F.lit(AS_OF)).count() == tables["member"].count()
    scores = tables["index_tscore_snapshot"].where(F.col("snapshot_date") == F.lit(AS_OF))
    for code in INDEX_CODES:
        mean, deviation = scores.agg(F.avg(f"{code}_tscore"), F.stddev_pop(f"{code}_tscore")).first()
        assert mean == pytest.approx(50) and deviation == pytest.approx(10)


def test_context_is_merged(spark, world):
    _, store, tables = world
    earlier = run_member_context(tables, store, run_of(INDEX_DATES[0]), NOW, check=False)
    first = {r.member_id: r for r in earlier.collect()}
    later = {r.member_id: r for r in run_member_context(tables, store, run_of(AS_OF), NOW, check=False).collect()}
    again = rows_of(run_member_context(tables, store, run_of(AS_OF), NOW, check=False))
    assert again == rows_of(read_replaced(spark, f"{store}/member_context", SCHEMAS["member_context"]))
    assert set(first) <= set(later) and {r.segment for r in later.values()} <= set(SEGMENTS)
    # The mapped subscriptions include ended plans still switched on, which the check counts.
    with pytest.raises(CheckFailed):
        run_member_context(tables, store, run_of(AS_OF), NOW)


def test_jobs_check_their_tables_first(spark, world, tmp_path):
    root, store, tables = world
    with pytest.raises(MissingTables, match="customer_event_logs_raw"):
        jobs.event_features_job(spark, str(tmp_path), store, "2024-01-30")
    with pytest.raises(MissingTables, match="internet$"):
        jobs.weekly_index_job(spark, root, store, "2024-01-30")
    with pytest.raises(MissingTables, match="user_event_features_7d, index_persona_snapshot, index_tscore_snapshot"):
        jobs.member_context_job(spark, root, str(tmp_path), NOW, "2024-01-30")
    with pytest.raises(ValueError):
        jobs.member_context_job(spark, root, store, NOW, "30.01.2024")


def test_jobs_run_from_folders(spark, world, tmp_path):
    root, _, tables = world
    store = str(tmp_path)
    for name in ["internet", "iptv", "tab_watch_plan"]:
        spark.range(1).write.mode("overwrite").parquet(f"{root}/{name}")
    assert jobs.event_features_job(spark, root, store, "2024-01-30").count() > 0
    found = jobs.weekly_index_job(spark, root, store, "2024-01-30")
    expected = tables["index_persona_snapshot"].where(F.col("snapshot_date") == F.lit(AS_OF))
    assert rows_of(found["index_persona_snapshot"]) == rows_of(expected)
    assert jobs.member_context_job(spark, root, store, NOW, "2024-01-30", check=False).count() > 0


def test_dispatch_job_sends_each_request_once(spark, world, tmp_path):
    root, _, tables = world
    store, folder = f"{tmp_path}/store", f"{tmp_path}/messages"
    with pytest.raises(MissingTables, match="support_case"):
        jobs.dispatch_job(spark, str(tmp_path), store, deliver_to_folder(folder), 7, NOW)
    cases = tables["support_case"].count()
    seeded = jobs.dispatch_job(spark, root, store, deliver_to_folder(folder), 7, NOW, chunk=50)
    assert (seeded.rounds, seeded.published, seeded.analyses.count()) == (0, 0, min(50, cases))
    drained = jobs.dispatch_job(spark, root, store, deliver_to_folder(folder), 8, NOW, chunk=50)
    assert (drained.published, drained.retried) == (cases, 0)
    assert drained.outbox.where("dispatch_status = 'SENT'").count() == cases
    again = jobs.dispatch_job(spark, root, store, deliver_to_folder(folder), 9, NOW, chunk=50)
    assert again.published == 0
    keys = read_messages(spark, folder).select("key")
    assert keys.count() == keys.distinct().count() == cases


def test_a_second_bill_is_named(spark, world, tmp_path):
    _, _, tables = world
    twice = tables["billing"].unionByName(tables["billing"].where("member_id = 11 AND yyyymm = '202312'"))
    with pytest.raises(DuplicateKeys, match="'member_id': 11"):
        run_weekly_index({**tables, "billing": twice}, str(tmp_path), run_of(AS_OF))
