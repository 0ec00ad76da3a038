"""Times the four jobs and the operators they lean on.

The driver's tables are mapped to member tables and written once, untimed; every timed run reads
those Parquet files and materialises its whole result. Each time is the median of three runs
after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import AS_OF, FEATURE_DATES, INDEX_DATES, NOW
from checks.queries import _deliver
from checks.staging import EVENT_LOG, stage, staged
from memberlytics.operators import activity, dispatch, events, index, profile, subscriptions
from memberlytics.params import RunParams, previous_month
from memberlytics.plans.dispatch import run_dispatch
from memberlytics.plans.event_features import run_event_features
from memberlytics.plans.member_context import run_member_context
from memberlytics.plans.weekly_index import run_weekly_index
from memberlytics.schemas import SCHEMAS
from memberlytics.session import tuned
from memberlytics.sources.event_logs import scan_event_logs
from memberlytics.sources.versions import read_snapshots

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run_of(day) -> RunParams:
    return RunParams(day, previous_month(day))


def main() -> None:
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (
        tuned(SparkSession.builder)
        .master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    root, store = f"{work}/tables", f"{work}/store"
    stage(spark, SF_DIR, root)
    source = staged(spark, root)
    log = f"{root}/{EVENT_LOG}"
    for day in FEATURE_DATES:
        run_event_features(spark, log, store, run_of(day))

    def snapshots(name: str) -> DataFrame:
        return read_snapshots(spark, f"{store}/{name}", SCHEMAS[name])

    index_tables = {**source, "user_event_features_7d": snapshots("user_event_features_7d")}
    for day in INDEX_DATES:
        run_weekly_index(index_tables, store, run_of(day))
    derived = ["user_event_features_7d", "index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot"]
    everything = {**source, **{name: snapshots(name) for name in derived}}

    def fresh() -> str:
        return f"{work}/run-{uuid.uuid4().hex}"

    def consume(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def scan() -> DataFrame:
        return scan_event_logs(spark, log, AS_OF)

    def active() -> DataFrame:
        return subscriptions.active_subscriptions(source["subscription"], source["product"], AS_OF)

    cases = source["support_case"]
    state = source["consultation_analysis"], source["analysis_dispatch_outbox"]
    claim = dispatch.ClaimParams(1, 7, 900, NOW)
    raw = everything["index_raw_snapshot"]

    def drain() -> None:
        drained = run_dispatch(cases, *state, _deliver, 1, 7, NOW, 900)
        consume(drained.analyses)
        consume(drained.outbox)

    daily = f"{work}/daily"
    run_event_features(spark, log, daily, run_of(AS_OF), incremental=True)

    timed = {
        "p1_event_features": lambda: run_event_features(spark, log, fresh(), run_of(AS_OF)),
        "p2_weekly_index": lambda: run_weekly_index(index_tables, fresh(), run_of(AS_OF)),
        "p3_member_context": lambda: run_member_context(everything, fresh(), run_of(AS_OF), NOW, check=False),
        "p4_drain_dispatch": drain,
        "event_features": lambda: consume(events.build_event_features(scan(), AS_OF)),
        "features_from_daily_sums": lambda: run_event_features(spark, log, daily, run_of(AS_OF), incremental=True),
        "top_tags": lambda: consume(events.top_tags(events.tag_counts(scan(), AS_OF))),
        "active_subscriptions": lambda: consume(active()),
        "raw_snapshot": lambda: consume(index.build_raw_snapshot(index_tables, run_of(AS_OF))),
        "tscore_snapshot": lambda: consume(index.build_tscore_snapshot(raw, AS_OF)),
        "persona_snapshot": lambda: consume(
            index.build_persona_snapshot(index.build_tscore_snapshot(raw, AS_OF), source["persona_type"], AS_OF)
        ),
        "recent_counseling": lambda: consume(activity.recent_counseling(cases)),
        "current_subscriptions": lambda: consume(subscriptions.current_subscriptions(active())),
        "member_context": lambda: consume(profile.build_member_context(everything, run_of(AS_OF), NOW)),
        "claim_chunk": lambda: consume(dispatch.claim_chunk(cases, *state, claim).outbox),
        "apply_results": lambda: consume(
            dispatch.apply_results(
                state[1], state[1].select("request_id", F.lit(True).alias("ok"), F.lit(None).alias("error")), NOW
            )
        ),
    }
    only = os.environ.get("BENCH_ONLY")
    seconds = {}
    for name, action in timed.items():
        if only and name not in only.split(","):
            continue
        action()
        laps = []
        for _ in range(RUNS):
            start = time.perf_counter()
            action()
            laps.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(laps), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_job_seconds",
                "value": round(sum(v for k, v in seconds.items() if k[0] == "p" and k[1].isdigit()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
