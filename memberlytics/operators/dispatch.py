"""Claim and dispatch of analysis requests as set-based state transitions.

State is two tables: `consultation_analysis` (one row per case and analyzer version) and
`analysis_dispatch_outbox` (one row per request). Every transition takes DataFrames and returns
DataFrames. There is one claimer per analyzer version; the clock is an argument.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memberlytics.functions.dates import timestamp_literal
from memberlytics.operators.merging import insert_ignore, upsert_columns
from memberlytics.operators.ranking import order_limit
from memberlytics.sources.versions import materialize

# Outbox type and states, defaults of the job, and the retry policy.
REQUEST = "REQUEST"
OPEN_STATES = ["READY", "RETRY"]
CLOSED_STATES = ["SENT", "ACKED", "DEAD"]
DEFAULT_CHUNK = 1000
DEFAULT_LEASE_SEC = 1800
DEFAULT_MAX_ATTEMPTS = 3
FIRST_RETRY_SEC = 60
ERROR_CHARS = 1000

CLAIM_UPDATES = [
    "job_instance_id", "chunk_id", "analysis_version", "dispatch_status", "next_retry_at", "last_error",
    "updated_at", "type", "claim_token", "claimed_started_at", "claimed_done_at",
]
DISPATCH_UPDATES = ["job_instance_id", "chunk_id", "analysis_version", "updated_at"]


@dataclass(frozen=True)
class ClaimParams:
    version: int
    job: int
    token: int
    now: datetime
    chunk: int = DEFAULT_CHUNK
    lease_sec: int = DEFAULT_LEASE_SEC


def request_id(case_id: Column, version: Column) -> Column:
    """SHA-256 of "case:version" in hex: the same request always has the same id."""
    case_text, version_text = case_id.cast("string"), version.cast("string")
    digest = F.sha2(F.concat(case_text, F.lit(":"), version_text), 256)
    blank = (F.trim(case_text) == "") | (F.trim(version_text) == "")
    return F.when(blank, F.raise_error(F.lit("case id and version must not be blank"))).otherwise(digest)


# -- seeding and picking ------------------------------------------------------------------------


def unseeded_cases(support_case: DataFrame, analyses: DataFrame, version: int) -> DataFrame:
    """Case ids without an analysis of this version."""
    seeded = analyses.where(F.col("analyzer_version") == version).select("case_id")
    return support_case.select("case_id").join(seeded, "case_id", "left_anti")


def last_analysis_id(analyses: DataFrame) -> DataFrame:
    return analyses.select(F.coalesce(F.max("analysis_id"), F.lit(0)).alias("last_id"))


def new_analyses(case_ids: DataFrame, last_id: Column, version: int, job: int) -> DataFrame:
    """Analysis rows for at most a chunk of cases, ids counting on from `last_id`.

    The unpartitioned numbering is over one chunk of ids, which the limit has brought to one
    task already.
    """
    place = F.row_number().over(Window.orderBy("case_id"))
    return case_ids.select(
        (last_id + place).cast("bigint").alias("analysis_id"),
        "case_id",
        F.lit(version).cast("bigint").alias("analyzer_version"),
        F.lit(job).cast("bigint").alias("job_instance_id"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def seed_analyses(support_case: DataFrame, analyses: DataFrame, version: int, job: int, chunk: int) -> DataFrame:
    """New analysis rows for the lowest `chunk` unseeded case ids."""
    lowest = order_limit(unseeded_cases(support_case, analyses, version), "case_id", chunk)
    return new_analyses(lowest, last_analysis_id(analyses).scalar(), version, job)


def claimable(now: datetime, lease_sec: int) -> Column:
    """Open, due, and not under another claim's lease."""
    due = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= timestamp_literal(now))
    started = F.col("claimed_started_at")
    lease_end = timestamp_literal(now - timedelta(seconds=lease_sec))
    free = started.isNull() | F.col("claimed_done_at").isNotNull() | (started < lease_end)
    return F.col("dispatch_status").isin(OPEN_STATES) & due & free


def backlog(analyses: DataFrame, outbox: DataFrame, version: int, now: datetime, lease_sec: int) -> DataFrame:
    """All analyses of the version that may be claimed now: those no outbox row stands in the way of."""
    blocked = outbox.where((F.col("type") == REQUEST) & ~F.coalesce(claimable(now, lease_sec), F.lit(False)))
    candidates = analyses.where(F.col("analyzer_version") == version).select(
        "analysis_id",
        "case_id",
        "analyzer_version",
        request_id(F.col("case_id"), F.col("analyzer_version")).alias("request_id"),
    )
    return candidates.join(blocked.select("request_id"), "request_id", "left_anti")


def pickable(
    analyses: DataFrame, outbox: DataFrame, version: int, now: datetime, lease_sec: int, chunk: int
) -> DataFrame:
    """The lowest `chunk` claimable analyses."""
    return order_limit(backlog(analyses, outbox, version, now, lease_sec), "analysis_id", chunk)


# -- claiming -----------------------------------------------------------------------------------


def claim_analyses(analyses: DataFrame, picked: DataFrame, job: int, now: datetime) -> DataFrame:
    """Picked analyses get the job id; all others stay."""
    marks = picked.select("analysis_id", F.lit(True).alias("_picked"))
    hit = F.col("_picked")
    return (
        analyses.join(marks, "analysis_id", "left")
        .withColumn("job_instance_id", F.when(hit, F.lit(job).cast("bigint")).otherwise(F.col("job_instance_id")))
        .withColumn("updated_at", F.when(hit, timestamp_literal(now)).otherwise(F.col("updated_at")))
        .select(analyses.columns)
    )


def claim_outbox(outbox: DataFrame, picked: DataFrame, job: int, now: datetime) -> DataFrame:
    """Record the claim of picked rows, whose `claim_token` they carry; attempts survive."""
    moment = timestamp_literal(now)
    empty = F.lit(None)
    updates = picked.select(
        "request_id",
        F.lit(job).cast("bigint").alias("job_instance_id"),
        F.col("claim_token").cast("string").alias("chunk_id"),
        F.col("analyzer_version").cast("string").alias("analysis_version"),
        F.lit("READY").alias("dispatch_status"),
        empty.cast("timestamp_ntz").alias("next_retry_at"),
        empty.cast("string").alias("last_error"),
        moment.alias("updated_at"),
        F.lit(REQUEST).alias("type"),
        "claim_token",
        moment.alias("claimed_started_at"),
        empty.cast("timestamp_ntz").alias("claimed_done_at"),
    )
    return upsert_columns(
        outbox, updates, "request_id", CLAIM_UPDATES, {"attempt_count": F.lit(0), "created_at": moment}
    )


@dataclass(frozen=True)
class Claim:
    """State after a claim and the rows it took."""

    analyses: DataFrame
    outbox: DataFrame
    claimed: DataFrame


def claim_chunk(support_case: DataFrame, analyses: DataFrame, outbox: DataFrame, params: ClaimParams) -> Claim:
    """Seed the next cases and claim the next analyses.

    Both look at the tables as they were before the call, so cases seeded here can be claimed by
    the next call at the earliest. Seeds and picks, a chunk at most of each, are written once: the
    states below read them several times and would search the backlog again each time.
    """
    seeds = materialize(seed_analyses(support_case, analyses, params.version, params.job, params.chunk), "seeds")
    picked = pickable(analyses, outbox, params.version, params.now, params.lease_sec, params.chunk)
    picked = materialize(picked.withColumn("claim_token", F.lit(params.token).cast("bigint")), "picks")
    updated = claim_analyses(analyses, picked, params.job, params.now)
    return Claim(
        insert_ignore(updated, seeds, ["case_id", "analyzer_version"]),
        claim_outbox(outbox, picked, params.job, params.now),
        picked,
    )


def claimed_targets(analyses: DataFrame, outbox: DataFrame, token: int) -> DataFrame:
    """Claimed requests of `token` that wait for dispatch; a negative token has none."""
    if token < 0:
        outbox = outbox.limit(0)
    waiting = outbox.where(
        (F.col("claim_token") == token)
        & (F.col("type") == REQUEST)
        & F.col("dispatch_status").isin(OPEN_STATES)
        & F.col("claimed_done_at").isNull()
    )
    keyed = analyses.withColumn("request_id", request_id(F.col("case_id"), F.col("analyzer_version")))
    joined = keyed.join(waiting.select("request_id"), "request_id")
    return joined.select("analysis_id", "case_id", "analyzer_version", "request_id").orderBy("analysis_id")


# -- dispatching --------------------------------------------------------------------------------


@dataclass(frozen=True)
class DispatchPlan:
    """Outbox after registration, requests to send, and requests already closed."""

    outbox: DataFrame
    to_send: DataFrame
    skipped: DataFrame


def register_dispatch(outbox: DataFrame, targets: DataFrame, job: int, now: datetime) -> DataFrame:
    """Insert missing outbox rows as READY; existing ones only learn job, chunk and version.

    `targets` carry the `claim_token` whose text becomes the chunk id.
    """
    moment = timestamp_literal(now)
    updates = targets.select(
        "request_id",
        F.lit(job).cast("bigint").alias("job_instance_id"),
        F.col("claim_token").cast("string").alias("chunk_id"),
        F.col("analyzer_version").cast("string").alias("analysis_version"),
        moment.alias("updated_at"),
    )
    defaults = {
        "dispatch_status": F.lit("READY"),
        "attempt_count": F.lit(0),
        "created_at": moment,
        "type": F.lit(REQUEST),
    }
    return upsert_columns(outbox, updates, "request_id", DISPATCH_UPDATES, defaults)


def plan_dispatch(targets: DataFrame, outbox: DataFrame, job: int, token: int, now: datetime) -> DispatchPlan:
    """Register the targets and split them by whether their request is still open."""
    if token < 0:
        raise ValueError("dispatch needs the token of a claim")
    targets = targets.withColumn("claim_token", F.lit(token).cast("bigint"))
    status = F.coalesce("dispatch_status", F.lit("READY"))
    found = targets.join(outbox.select("request_id", "dispatch_status"), "request_id", "left")
    closed = status.isin(CLOSED_STATES)
    return DispatchPlan(
        register_dispatch(outbox, targets, job, now),
        found.where(~closed).select(targets.columns),
        found.where(closed).select(targets.columns),
    )


def apply_results(
    outbox: DataFrame, results: DataFrame, now: datetime, max_attempts: int = DEFAULT_MAX_ATTEMPTS
) -> DataFrame:
    """Apply delivery results (`request_id`, `ok`, `error`).

    Of several answers to one request a success counts, else the failure with the largest text: delivery
    is at least once. Delivered requests become SENT. Failed ones wait 1, 2, 4 ... minutes for a retry, until the
    attempts are used up and they become DEAD.
    """
    moment = timestamp_literal(now)
    answers = results.groupBy("request_id").agg(
        F.max("ok").alias("_ok"), F.max(F.when(~F.col("ok"), F.col("error"))).alias("_error")
    )
    joined = outbox.join(answers, "request_id", "left")

    answered = F.col("_ok").isNotNull() & (F.col("type") == REQUEST)
    sent, attempts = F.col("_ok"), F.col("attempt_count")
    dead = attempts + 1 >= max_attempts
    wait_sec = (FIRST_RETRY_SEC * F.pow(F.lit(2.0), F.greatest(attempts, F.lit(0)))).cast("int")
    error = F.when(F.col("_error").rlike(r"\S"), F.col("_error")).otherwise(F.lit("Exception"))

    changed = {
        "dispatch_status": F.when(sent, "SENT").when(dead, "DEAD").otherwise("RETRY"),
        "attempt_count": attempts + 1,
        "next_retry_at": F.when(~sent & ~dead, moment + F.make_dt_interval(secs=wait_sec)),
        "last_error": F.when(~sent, F.substring(error, 1, ERROR_CHARS)),
        "claimed_done_at": moment,
        "updated_at": moment,
    }
    return joined.select(
        *[F.when(answered, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else c for c in outbox.columns]
    )


def dispatch_counts(plan: DispatchPlan, results: DataFrame) -> DataFrame:
    """One row: requests published, skipped and sent to retry."""
    tally = results.select(F.count_if("ok").alias("published"), F.count_if(~F.col("ok")).alias("retried"))
    skipped = plan.skipped.select(F.count(F.lit(1))).scalar()
    return tally.select("published", skipped.alias("skipped"), "retried")
