"""Dispatch job: claim and deliver in chunks until nothing is left to claim.

With one reading of the clock the rounds do not depend on what delivery answers, so they need not be
run one after the other: backlog and unseeded cases are ranked once, the rank tells the round, and
all rounds are claimed, delivered and merged as sets, in a fixed number of Spark jobs.

A stored drain keeps a journal, so that one that dies is finished by the next start:

    store/dispatch_runs/run=<id>/picks, seeds    what the run has claimed and seeded
    store/dispatch_runs/run=<id>/results         answers, written after each wave of rounds
    store/dispatch_runs/journal/*.json           a line when picks and seeds are complete, another when the run has ended

Requests with a recorded answer are not sent again; those of the wave that died may be, under the same
ids: `wave_rounds` rounds at most, or one of MAX_WAVES parts of the run if that is more. Analyses and outbox change in one commit at the end of a run, which names the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.operators.dispatch import (
    DEFAULT_CHUNK,
    DEFAULT_LEASE_SEC,
    DEFAULT_MAX_ATTEMPTS,
    apply_results,
    backlog,
    claim_analyses,
    claim_outbox,
    last_analysis_id,
    request_id,
    unseeded_cases,
)
from memberlytics.operators.merging import insert_ignore
from memberlytics.operators.ranking import ranked
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.messages import to_request_messages
from memberlytics.sources.versions import note_of, read_replaced, replace_tables, shared_folder

ANALYSES, OUTBOX = "consultation_analysis", "analysis_dispatch_outbox"

# Messages in; one row per request (`request_id`, `ok`, `error`) out.
Deliver = Callable[[DataFrame], DataFrame]
RESULTS = "request_id string, ok boolean, error string"
PICKS = "analysis_id bigint, case_id bigint, analyzer_version bigint, request_id string, claim_token bigint"
JOURNAL = "run string, job bigint, now timestamp_ntz, first_token bigint, rounds bigint, max_attempts int, ended boolean"
RUNS = "dispatch_runs"
# Rounds whose answers are recorded together, and the waves a drain has at most: each costs a few Spark jobs whatever
# its size, so a drain of more rounds than both together has longer waves.
WAVE_ROUNDS = 100
MAX_WAVES = 16


@dataclass(frozen=True)
class Drained:
    """State after a drain, and its requests: sent, failed, and not sent again as an earlier start had recorded them."""

    analyses: DataFrame
    outbox: DataFrame
    rounds: int
    published: int
    retried: int
    skipped: int = 0


@dataclass(frozen=True)
class Run:
    """A drain whose picks and seeds are stored in `folder`."""

    folder: str
    job: int
    now: datetime
    first_token: int
    rounds: int
    max_attempts: int


def run_dispatch(
    support_case: DataFrame,
    analyses: DataFrame,
    outbox: DataFrame,
    deliver: Deliver,
    version: int,
    job: int,
    now: datetime,
    first_token: int | None = None,
    chunk: int = DEFAULT_CHUNK,
    lease_sec: int = DEFAULT_LEASE_SEC,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
) -> Drained:
    """One drain by one reading of the clock: a request that fails waits for a later run.

    The result is that of repeated calls of `claim_chunk`, round n under token `first_token + n`
    (by default the microseconds of `now`, so tokens of different runs differ). A round claims the
    lowest `chunk` rows of what waits and seeds `chunk` cases for later rounds, and the first round
    that finds nothing ends the drain. Hence, by rank:

    - a backlog of at least a chunk: backlog, then seeds, fill round after round;
    - a smaller one is round 0, and seeds fill the rounds from 1 on;
    - without a backlog, one chunk is seeded and nothing is claimed.
    """
    folder = f"{shared_folder(analyses.sparkSession)}/dispatch-{uuid.uuid4().hex}"
    run = begin_run(support_case, analyses, outbox, folder, version, job, now, first_token, chunk, lease_sec, max_attempts)
    return finish_run(analyses, outbox, run, deliver)


def begin_run(
    support_case: DataFrame,
    analyses: DataFrame,
    outbox: DataFrame,
    folder: str,
    version: int,
    job: int,
    now: datetime,
    first_token: int | None,
    chunk: int,
    lease_sec: int,
    max_attempts: int,
) -> Run:
    """Decide and store what the drain seeds and claims, and in which round."""
    if first_token is None:
        first_token = int(now.timestamp() * 1_000_000)

    waiting = ranked(backlog(analyses, outbox, version, now, lease_sec), "analysis_id", "rank", f"{folder}/backlog")
    unseeded = ranked(unseeded_cases(support_case, analyses, version), "case_id", "rank", f"{folder}/unseeded")
    n_waiting, n_unseeded = waiting.count(), unseeded.count()
    last_id = last_analysis_id(analyses).first()["last_id"]

    seeds = unseeded if n_waiting else unseeded.where(F.col("rank") < chunk)
    seeds = seeds.withColumn("analysis_id", F.col("rank") + last_id + 1)
    seeds = seeds.withColumn("analyzer_version", F.lit(version).cast("bigint"))
    seeded = seeds.select(
        "analysis_id",
        "case_id",
        "analyzer_version",
        F.lit(job).cast("bigint").alias("job_instance_id"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )

    def in_round(round_: Column) -> Column:
        return (first_token + round_).cast("bigint").alias("claim_token")

    # Rank of the first seed in what fills the rounds.
    shift = n_waiting if n_waiting >= chunk else chunk
    picked = waiting.select("analysis_id", "case_id", "analyzer_version", "request_id", in_round(F.floor(F.col("rank") / chunk)))
    rounds = -(-n_waiting // chunk)
    if n_waiting:
        claimed_seeds = seeds.select(
            "analysis_id",
            "case_id",
            "analyzer_version",
            request_id(F.col("case_id"), F.col("analyzer_version")).alias("request_id"),
            in_round(F.floor((F.col("rank") + shift) / chunk)),
        )
        picked = picked.unionByName(claimed_seeds)
        rounds = -(-(shift + n_unseeded) // chunk) if n_unseeded else rounds

    _write_picks(picked, f"{folder}/picks")
    seeded.write.parquet(f"{folder}/seeds")
    return Run(folder, job, now, first_token, rounds, max_attempts)


def _write_picks(picked: DataFrame, path: str) -> None:
    """In the order of their rounds, so that a wave opens its own part of the files; the id splits large rounds."""
    order = ["claim_token", "analysis_id"]
    picked.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def _recorded(spark: SparkSession, run: Run) -> DataFrame | None:
    try:
        return spark.read.schema(RESULTS).parquet(f"{run.folder}/results")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def finish_run(analyses: DataFrame, outbox: DataFrame, run: Run, deliver: Deliver, wave_rounds: int | None = None) -> Drained:
    """Send what has no recorded answer, wave by wave, and merge.

    A wave takes `wave_rounds` rounds (all unless told), or more where that would make over MAX_WAVES waves.
    """
    spark = analyses.sparkSession
    picks = spark.read.schema(PICKS).parquet(f"{run.folder}/picks")
    seeded = spark.read.schema(SCHEMAS[ANALYSES]).parquet(f"{run.folder}/seeds")
    before = _recorded(spark, run)
    step = max(wave_rounds or run.rounds, -(-run.rounds // MAX_WAVES), 1)
    place = F.col("claim_token") - run.first_token

    if before is None:
        skipped, open_picks, waves = 0, picks, range(-(-max(run.rounds, 1) // step))
    else:
        skipped = before.select("request_id").distinct().count()
        path = f"{run.folder}/open-{uuid.uuid4().hex}"
        _write_picks(picks.join(before.select("request_id"), "request_id", "left_anti"), path)
        open_picks = spark.read.schema(PICKS).parquet(path)
        found = open_picks.select(F.floor(place / step).alias("wave")).distinct()
        waves = sorted(row["wave"] for row in found.collect())
    for wave in waves:
        due = open_picks.where((F.col("claim_token") >= run.first_token + wave * step) & (F.col("claim_token") < run.first_token + (wave + 1) * step))
        answers = deliver(to_request_messages(due)).select("request_id", "ok", "error")
        answers.write.mode("append").parquet(f"{run.folder}/results")
    results = spark.read.schema(RESULTS).parquet(f"{run.folder}/results")
    tally = results.select(F.count_if("ok").alias("published"), F.count_if(~F.col("ok")).alias("retried")).first()

    claimed = claim_analyses(insert_ignore(analyses, seeded, ["case_id", "analyzer_version"]), picks, run.job, run.now)
    # The claim has left every picked request registered and open, so all of them are sent.
    registered = claim_outbox(outbox, picks, run.job, run.now)
    after = apply_results(registered, results, run.now, run.max_attempts)
    return Drained(claimed, after, run.rounds, tally["published"], tally["retried"], skipped)


# -- stored state -------------------------------------------------------------------------------


def _log_run(spark: SparkSession, store: str, name: str, run: Run, ended: bool) -> None:
    values = {"run": name, "job": run.job, "now": str(run.now), "first_token": run.first_token, "rounds": run.rounds, "max_attempts": run.max_attempts, "ended": ended}
    line = spark.range(1).select(*[F.lit(value).alias(column) for column, value in values.items()])
    line.coalesce(1).write.mode("append").json(f"{store}/{RUNS}/journal")


def _open_run(spark: SparkSession, store: str) -> tuple[str, Run] | None:
    """The run that an earlier start has begun and not ended. There is one writer, so there is one at most."""
    try:
        journal = spark.read.schema(JOURNAL).json(f"{store}/{RUNS}/journal")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    runs = journal.groupBy("run", "job", "now", "first_token", "rounds", "max_attempts").agg(F.max("ended").alias("ended"))
    row = runs.where(~F.col("ended")).first()
    if row is None:
        return None
    name, run = row["run"], Run(f"{store}/{RUNS}/run={row['run']}", row["job"], row["now"], row["first_token"], row["rounds"], row["max_attempts"])
    if note_of(spark, f"{store}/{OUTBOX}") == name:  # it died between its commit and the line that ends it
        _log_run(spark, store, name, run, ended=True)
        return None
    return name, run


def _state(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    analyses, outbox = (read_replaced(spark, f"{store}/{name}", SCHEMAS[name]) for name in (ANALYSES, OUTBOX))
    return analyses, outbox


def _finish_stored(spark: SparkSession, store: str, name: str, run: Run, deliver: Deliver, wave_rounds: int) -> Drained:
    drained = finish_run(*_state(spark, store), run, deliver, wave_rounds)
    stored = replace_tables({ANALYSES: drained.analyses, OUTBOX: drained.outbox}, store, note=name)
    _log_run(spark, store, name, run, ended=True)
    return replace(drained, analyses=stored[ANALYSES], outbox=stored[OUTBOX])


def run_stored_dispatch(
    support_case: DataFrame,
    store: str,
    deliver: Deliver,
    version: int,
    job: int,
    now: datetime,
    first_token: int | None = None,
    chunk: int = DEFAULT_CHUNK,
    lease_sec: int = DEFAULT_LEASE_SEC,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
    wave_rounds: int = WAVE_ROUNDS,
    clock: Callable[[], datetime] | None = None,
) -> Drained:
    """`run_dispatch` on the stored state, which it replaces, after finishing a run that has died.

    With `clock`, further drains follow, each by a new reading, until one finds nothing to claim: requests
    that have failed are sent again within the call once their time has come. Counts are those of all drains.
    """
    spark, drains = support_case.sparkSession, []
    unfinished = _open_run(spark, store)
    if unfinished:
        drains.append(_finish_stored(spark, store, *unfinished, deliver, wave_rounds))
    while True:
        name = f"{version}-{job}-{uuid.uuid4().hex[:12]}"
        folder = f"{store}/{RUNS}/run={name}"
        run = begin_run(support_case, *_state(spark, store), folder, version, job, now, first_token, chunk, lease_sec, max_attempts)
        _log_run(spark, store, name, run, ended=False)
        drains.append(_finish_stored(spark, store, name, run, deliver, wave_rounds))
        if clock is None or run.rounds == 0:
            break
        now = clock()
        first_token = None if first_token is None else first_token + run.rounds
    totals = {count: sum(getattr(d, count) for d in drains) for count in ("rounds", "published", "retried", "skipped")}
    return replace(drains[-1], **totals)
