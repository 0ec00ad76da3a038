"""The jobs as a scheduler starts them: resolve the date, check the tables, read them, run.

`root` holds the source tables, `store` what the jobs produce; a job creates its own result table
on the first run, so only what it reads is required to exist.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from memberlytics.params import resolve_params
from memberlytics.operators.dispatch import DEFAULT_CHUNK, DEFAULT_LEASE_SEC, DEFAULT_MAX_ATTEMPTS
from memberlytics.plans.dispatch import Deliver, Drained, run_stored_dispatch
from memberlytics.plans.event_features import TABLE as FEATURES
from memberlytics.plans.event_features import run_event_features
from memberlytics.plans.member_context import TABLE as CONTEXT
from memberlytics.plans.member_context import run_member_context
from memberlytics.plans.weekly_index import run_weekly_index
from memberlytics.schemas import REQUIRED_TABLES, SCHEMAS
from memberlytics.sources.tables import MissingTables, read_table, require_tables
from memberlytics.sources.versions import has_snapshots, read_snapshots

EVENT_LOG = "customer_event_logs_raw"
CASES = "support_case"
INDEX_TABLES = ["index_raw_snapshot", "index_tscore_snapshot", "index_persona_snapshot"]
# Tables the index reads beyond those its start-up check asks for.
INDEX_EXTRA = ["persona_type"]


def event_features_job(spark: SparkSession, root: str, store: str, snapshot_date: str | None = None) -> DataFrame:
    params = resolve_params(snapshot_date)
    require_tables(spark, _wanted("event_features", [FEATURES], [EVENT_LOG]), root)
    return run_event_features(spark, f"{root}/{EVENT_LOG}", store, params, incremental=True)


def weekly_index_job(
    spark: SparkSession, root: str, store: str, snapshot_date: str | None = None, strict_integer_guard: bool = True
) -> dict[str, DataFrame]:
    params = resolve_params(snapshot_date)
    tables = _inputs(spark, root, store, "weekly_index", INDEX_TABLES, INDEX_EXTRA, list_all=False)
    return run_weekly_index(tables, store, params, strict_integer_guard)


def member_context_job(
    spark: SparkSession,
    root: str,
    store: str,
    now: datetime,
    snapshot_date: str | None = None,
    bound_to_as_of: bool = False,
    check: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    params = resolve_params(snapshot_date)
    tables = _inputs(spark, root, store, "member_context", [CONTEXT], [], list_all=True)
    return run_member_context(tables, store, params, now, bound_to_as_of, check, buckets)


def dispatch_job(
    spark: SparkSession,
    root: str,
    store: str,
    deliver: Deliver,
    job: int,
    now: datetime,
    version: int = 1,
    chunk: int = DEFAULT_CHUNK,
    lease_sec: int = DEFAULT_LEASE_SEC,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
    clock: Callable[[], datetime] | None = None,
) -> Drained:
    """Claim and deliver all that waits, after finishing a run that has died. Analyses and outbox live in `store`,
    where the first run creates them. With `clock`, failed requests that come due meanwhile are sent again."""
    require_tables(spark, [CASES], root)
    settings = {"chunk": chunk, "lease_sec": lease_sec, "max_attempts": max_attempts}
    return run_stored_dispatch(read_table(spark, root, CASES), store, deliver, version=version, job=job, now=now, clock=clock, **settings)


def _wanted(job: str, results: list[str], extra: list[str]) -> list[str]:
    """What a job asks for at its start, but for the tables that it creates itself."""
    return [name for name in [*REQUIRED_TABLES[job], *extra] if name not in results]


def _inputs(
    spark: SparkSession,
    root: str,
    store: str,
    job: str,
    results: list[str],
    extra: list[str],
    list_all: bool,
) -> dict[str, DataFrame]:
    wanted = _wanted(job, results, extra)
    produced = [name for name in wanted if name in [FEATURES, *INDEX_TABLES]]
    require_tables(spark, [name for name in wanted if name not in produced], root, list_all)
    missing = [name for name in produced if not has_snapshots(spark, f"{store}/{name}")]
    if missing:
        raise MissingTables("run the jobs first that produce: " + ", ".join(missing))
    # Some required tables have no schema here, as no query reads them.
    tables = {name: read_table(spark, root, name) for name in wanted if name in SCHEMAS and name not in produced}
    return tables | {name: read_snapshots(spark, f"{store}/{name}", SCHEMAS[name]) for name in produced}
