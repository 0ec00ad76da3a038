"""Claim and dispatch on hand-made state, and the drain against repeated single claims."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from memberlytics.operators import dispatch as d
from memberlytics.plans.dispatch import ANALYSES, MAX_WAVES, OUTBOX, run_dispatch, run_stored_dispatch
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.messages import to_request_messages
from memberlytics.sources import versions
from memberlytics.sources.versions import read_replaced, replace_table

NOW = datetime(2024, 1, 30, 12)
SEC = timedelta(seconds=1)


def key(case_id, version=1):
    return hashlib.sha256(f"{case_id}:{version}".encode()).hexdigest()


def cases(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "case_id bigint")


def analyses(spark, ids, version=1):
    return spark.createDataFrame([(i * 10, i, version, 1, None) for i in ids], SCHEMAS[ANALYSES])


def outbox(spark, *rows):
    """(case, status, attempts, next retry, claim started, claim done)"""
    full = [
        (key(c), 1, "5", "1", status, attempts, retry, None, NOW - 9 * SEC, NOW - 9 * SEC, "REQUEST", 5, started, done)
        for c, status, attempts, retry, started, done in rows
    ]
    return spark.createDataFrame(full, SCHEMAS[OUTBOX])


def params(chunk=10, token=77):
    return d.ClaimParams(version=1, job=8, token=token, now=NOW, chunk=chunk)


def test_request_id(spark):
    row = spark.range(1).select(d.request_id(F.lit(12), F.lit(3)), d.request_id(F.lit("12"), F.lit("3"))).first()
    assert row[0] == row[1] == key(12, 3)
    with pytest.raises(PySparkException, match="blank"):
        spark.range(1).select(d.request_id(F.lit(" "), F.lit("3"))).collect()


def test_claimable_boundaries(spark):
    lease = timedelta(seconds=1800)
    rows = [
        (1, "READY", 0, None, NOW - lease - SEC, None), (2, "READY", 0, None, NOW - lease, None), (3, "RETRY", 0, NOW + SEC, None, None),
        (4, "RETRY", 0, NOW, None, None), (5, "SENT", 1, None, None, None), (6, "DEAD", 3, None, None, None), (7, "ACKED", 1, None, None, None),
        (8, "READY", 0, None, NOW, NOW), (9, "READY", 0, None, None, None),
    ]
    found = d.pickable(analyses(spark, range(1, 12)), outbox(spark, *rows), 1, NOW, 1800, 100)
    assert [r.case_id for r in found.collect()] == [1, 4, 8, 9, 10, 11]
    assert [r.case_id for r in d.pickable(analyses(spark, range(1, 12)), outbox(spark, *rows), 1, NOW, 1800, 2).collect()] == [1, 4]


def test_other_versions_are_apart(spark):
    both = analyses(spark, [1, 2]).unionByName(analyses(spark, [1, 2, 3], version=2))
    assert d.pickable(both, outbox(spark), 1, NOW, 1800, 10).count() == 2
    assert [r.case_id for r in d.seed_analyses(cases(spark, [1, 2, 3]), both, 1, 8, 10).collect()] == [3]


def test_seeded_cases_wait_for_the_next_claim(spark):
    all_cases = cases(spark, [5, 3, 1, 4, 2])
    first = d.claim_chunk(all_cases, analyses(spark, []), outbox(spark), params(chunk=3))
    assert first.claimed.count() == 0 and first.outbox.count() == 0
    assert sorted((r.analysis_id, r.case_id) for r in first.analyses.collect()) == [(1, 1), (2, 2), (3, 3)]

    second = d.claim_chunk(all_cases, first.analyses, first.outbox, params(chunk=3))
    assert [r.case_id for r in second.claimed.orderBy("analysis_id").collect()] == [1, 2, 3]
    assert sorted(r.case_id for r in second.analyses.collect()) == [1, 2, 3, 4, 5]
    assert {r.dispatch_status for r in second.outbox.collect()} == {"READY"}


def test_claim_resets_all_but_attempts_and_creation(spark):
    claim = d.claim_chunk(cases(spark, []), analyses(spark, [1]), outbox(spark, (1, "RETRY", 2, NOW, NOW - 9999 * SEC, NOW - SEC)), params())
    row = claim.outbox.first()
    assert (row.dispatch_status, row.attempt_count, row.created_at) == ("READY", 2, NOW - 9 * SEC)
    assert (row.next_retry_at, row.last_error, row.claimed_done_at) == (None, None, None)
    assert (row.claim_token, row.chunk_id, row.claimed_started_at, row.job_instance_id) == (77, "77", NOW, 8)
    analysis = claim.analyses.first()
    assert (analysis.job_instance_id, analysis.updated_at) == (8, NOW)


def test_targets_of_a_token(spark):
    state = outbox(spark, (1, "READY", 0, None, NOW, None), (2, "SENT", 1, None, NOW, NOW), (3, "READY", 0, None, NOW, NOW), (4, "RETRY", 1, None, NOW, None))
    all_analyses = analyses(spark, [4, 3, 2, 1])
    assert [r.case_id for r in d.claimed_targets(all_analyses, state, 5).collect()] == [1, 4]
    assert d.claimed_targets(all_analyses, state, 6).count() == 0
    assert d.claimed_targets(all_analyses, state, -5).count() == 0
    with pytest.raises(ValueError):
        d.plan_dispatch(all_analyses, state, 8, -1, NOW)


def test_closed_requests_are_skipped(spark):
    state = outbox(spark, (1, "READY", 0, None, NOW, None), (2, "SENT", 1, None, NOW, NOW), (3, "ACKED", 1, None, NOW, NOW), (4, "DEAD", 3, None, NOW, NOW))
    targets = analyses(spark, [1, 2, 3, 4, 5]).withColumn("request_id", d.request_id(F.col("case_id"), F.col("analyzer_version")))
    plan = d.plan_dispatch(targets, state, 8, 77, NOW)
    assert sorted(r.case_id for r in plan.to_send.collect()) == [1, 5]
    assert sorted(r.case_id for r in plan.skipped.collect()) == [2, 3, 4]
    rows = {r.request_id: r for r in plan.outbox.collect()}
    assert rows[key(2)].dispatch_status == "SENT" and rows[key(2)].chunk_id == "77" and rows[key(2)].claim_token == 5
    assert (rows[key(5)].dispatch_status, rows[key(5)].attempt_count, rows[key(5)].type) == ("READY", 0, "REQUEST")
    results = plan.to_send.select("request_id", (F.col("case_id") == 1).alias("ok"), F.lit("e").alias("error"))
    assert tuple(d.dispatch_counts(plan, results).first()) == (1, 3, 1)


def test_results(spark):
    state = outbox(spark, *[(c, "READY", a, NOW, NOW, None) for c, a in [(1, 0), (2, 1), (3, 2), (4, 0), (5, 0), (6, 0)]])
    results = [(key(1), False, "e" * 1200), (key(2), False, "late"), (key(3), False, None), (key(4), True, None), (key(5), False, "  ")]
    rows = {r.request_id: r for r in d.apply_results(state, spark.createDataFrame(results, "request_id string, ok boolean, error string"), NOW).collect()}

    def outcome(case):
        row = rows[key(case)]
        return row.dispatch_status, row.attempt_count, row.next_retry_at, row.last_error, row.claimed_done_at

    assert outcome(1) == ("RETRY", 1, NOW + 60 * SEC, "e" * 1000, NOW)
    assert outcome(2) == ("RETRY", 2, NOW + 120 * SEC, "late", NOW)
    assert outcome(3) == ("DEAD", 3, None, "Exception", NOW)
    assert outcome(4) == ("SENT", 1, None, None, NOW)
    assert outcome(5)[3] == "Exception"
    assert outcome(6) == ("READY", 0, NOW, None, None)


def test_messages(spark):
    targets = analyses(spark, [3]).withColumn("request_id", F.lit("k"))
    assert tuple(to_request_messages(targets).first()) == ("k", '{"dispatchRequestId":"k","caseId":3,"analyzerVersion":1}')


def deliver(messages):
    case_id = F.get_json_object("value", "$.caseId").cast("bigint")
    return messages.select(F.col("key").alias("request_id"), (case_id % 3 != 0).alias("ok"), F.lit("no").alias("error"))


def state_of(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("seeded,claimed,chunk", [(12, 6, 5), (0, 0, 4), (9, 9, 100)])
def test_drain_equals_repeated_claims(spark, seeded, claimed, chunk):
    rng = random.Random(seeded)
    total = 14
    all_cases = cases(spark, range(total))
    first_analyses = analyses(spark, range(seeded))
    rows = [
        (c, rng.choice(["READY", "RETRY", "SENT", "DEAD"]), rng.randrange(3), rng.choice([None, NOW + SEC, NOW - SEC]), rng.choice([None, NOW]), None)
        for c in range(claimed)
    ]
    first_outbox = outbox(spark, *rows)
    drained = run_dispatch(all_cases, first_analyses, first_outbox, deliver, 1, 8, NOW, 100, chunk)

    stand, box, rounds = first_analyses, first_outbox, 0
    while True:
        claim = d.claim_chunk(all_cases, stand, box, params(chunk, 100 + rounds))
        box_rows, stand_rows, picked = claim.outbox.collect(), claim.analyses.collect(), claim.claimed.count()
        stand, box = spark.createDataFrame(stand_rows, SCHEMAS[ANALYSES]), spark.createDataFrame(box_rows, SCHEMAS[OUTBOX])
        if picked == 0:
            break
        plan = d.plan_dispatch(d.claimed_targets(stand, box, 100 + rounds), box, 8, 100 + rounds, NOW)
        after = d.apply_results(plan.outbox, deliver(to_request_messages(plan.to_send)), NOW).collect()
        box = spark.createDataFrame(after, SCHEMAS[OUTBOX])
        rounds += 1

    assert drained.rounds == rounds
    assert state_of(drained.outbox, SCHEMAS[OUTBOX].names) == state_of(box, SCHEMAS[OUTBOX].names)
    names = ["analysis_id", "case_id", "analyzer_version", "job_instance_id"]
    assert state_of(drained.analyses, names) == state_of(stand, names)


def test_stored_drain_sends_nothing_twice_and_ends(spark, tmp_path):
    store = str(tmp_path)
    replace_table(analyses(spark, range(6)), f"{store}/{ANALYSES}")
    sent = []

    def recording(messages):
        sent.extend(r.key for r in messages.collect())
        return deliver(messages)

    settings = {"version": 1, "job": 8, "chunk": 4}
    now, tries = NOW, []
    while True:
        before = len(sent)
        run_stored_dispatch(cases(spark, range(9)), store, recording, now=now, first_token=len(tries) * 100, **settings)
        if len(sent) == before:
            break
        tries.append(sent[before:])
        assert len(set(tries[-1])) == len(tries[-1])
        now += timedelta(hours=1)
    rows = {r.request_id: r for r in read_replaced(spark, f"{store}/{OUTBOX}", SCHEMAS[OUTBOX]).collect()}
    assert [len(t) for t in tries] == [9, 3, 3]
    assert {rows[key(c)].dispatch_status for c in range(9) if c % 3} == {"SENT"}
    assert {(rows[key(c)].dispatch_status, rows[key(c)].attempt_count) for c in range(0, 9, 3)} == {("DEAD", 3)}


def test_drain_takes_as_many_jobs_however_many_rounds(spark):
    def jobs(chunk):
        spark.sparkContext.setJobGroup(f"drain-{chunk}", "")
        drained = run_dispatch(cases(spark, range(40)), analyses(spark, range(20)), outbox(spark), deliver, 1, 8, NOW, 100, chunk)
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"drain-{chunk}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return drained.rounds, len(found), drained.published + drained.retried

    few, many = jobs(20), jobs(2)
    assert (few[0], many[0]) == (2, 20) and few[2] == many[2] == 40
    assert many[1] <= few[1] + 2


class Broker:
    """Answers as `deliver` does, notes what it is sent, and breaks at some of its calls."""

    def __init__(self, breaks=()):
        self.sent, self.calls, self.breaks = [], 0, breaks

    def __call__(self, messages):
        self.calls += 1
        if self.calls in self.breaks:
            raise ConnectionError("broker gone")
        self.sent.append([r.key for r in messages.collect()])
        return deliver(messages)


def stored_state(spark, store):
    box = read_replaced(spark, f"{store}/{OUTBOX}", SCHEMAS[OUTBOX]).fillna("-")
    return state_of(box, ["request_id", "dispatch_status", "attempt_count", "last_error"]), state_of(read_replaced(spark, f"{store}/{ANALYSES}", SCHEMAS[ANALYSES]), ["analysis_id", "case_id", "job_instance_id"])


def test_a_drain_that_dies_is_finished_without_sending_twice(spark, tmp_path):
    settings = {"version": 1, "job": 8, "now": NOW, "chunk": 3, "wave_rounds": 1}
    plain, broken = str(tmp_path / "plain"), str(tmp_path / "broken")
    for store in (plain, broken):
        replace_table(analyses(spark, range(8)), f"{store}/{ANALYSES}")
    whole = Broker()
    expected = run_stored_dispatch(cases(spark, range(14)), plain, whole, **settings)
    broker = Broker(breaks=(3,))
    with pytest.raises(ConnectionError):
        run_stored_dispatch(cases(spark, range(14)), broken, broker, **settings)
    assert len(broker.sent) == 2 and read_replaced(spark, f"{broken}/{OUTBOX}", SCHEMAS[OUTBOX]).count() == 0
    # The state is as before; the next start, at another time and for another job, finishes the run first.
    later = {**settings, "job": 9, "now": NOW + 30 * SEC}
    finished = run_stored_dispatch(cases(spark, range(14)), broken, broker, **later)
    keys = [key for wave in broker.sent for key in wave]
    assert len(keys) == len(set(keys)) == 14 and sorted(keys) == sorted(key for wave in whole.sent for key in wave)
    assert (finished.published, finished.retried, finished.skipped) == (expected.published, expected.retried, len(broker.sent[0]) + len(broker.sent[1]))
    assert stored_state(spark, broken) == stored_state(spark, plain)
    assert expected.skipped == 0
    third = run_stored_dispatch(cases(spark, range(14)), broken, broker, **later)
    assert (third.published, third.retried, third.skipped) == (0, 0, 0)


def test_a_stored_drain_has_a_bounded_number_of_waves(spark, tmp_path):
    """One wave for each of 40 rounds would be 40 deliveries."""
    settings = {"version": 1, "job": 8, "now": NOW, "chunk": 1, "wave_rounds": 1}
    store, broker = str(tmp_path), Broker(breaks=(3,))
    replace_table(analyses(spark, range(20)), f"{store}/{ANALYSES}")
    with pytest.raises(ConnectionError):
        run_stored_dispatch(cases(spark, range(40)), store, broker, **settings)
    assert [len(wave) for wave in broker.sent] == [3, 3]
    finished = run_stored_dispatch(cases(spark, range(40)), store, broker, **settings)
    keys = [key for wave in broker.sent for key in wave]
    assert len(keys) == len(set(keys)) == 40 == finished.published + finished.retried
    # The broken call, and one empty wave of the drain that follows the finished one.
    assert broker.calls <= MAX_WAVES + 2


@pytest.mark.parametrize("dies_at", ["tables", "end"])
def test_analyses_and_outbox_change_together(spark, tmp_path, monkeypatch, dies_at):
    store = str(tmp_path)
    replace_table(analyses(spark, range(4)), f"{store}/{ANALYSES}")
    before = stored_state(spark, store)
    broker, settings = Broker(), {"version": 1, "job": 8, "now": NOW, "chunk": 3}

    def dies(*args, **kwargs):
        raise OSError("driver gone")

    with monkeypatch.context() as patch:
        if dies_at == "tables":  # both are written, nothing points to them yet
            patch.setattr(versions, "_point", dies)
        else:  # both are current, the journal does not know it
            from memberlytics.plans import dispatch as plan

            log_run = plan._log_run
            patch.setattr(plan, "_log_run", lambda *a, ended: dies() if ended else log_run(*a, ended=ended))
        with pytest.raises(OSError):
            run_stored_dispatch(cases(spark, range(6)), store, broker, **settings)
    after = stored_state(spark, store)
    assert after == before if dies_at == "tables" else len(after[0]) == len(after[1]) == 6
    run_stored_dispatch(cases(spark, range(6)), store, broker, **settings)
    keys = [key for wave in broker.sent for key in wave]
    assert len(keys) == len(set(keys)) == 6
    outbox_rows, analysis_rows = stored_state(spark, store)
    assert len(outbox_rows) == len(analysis_rows) == 6
    assert {row[1] for row in outbox_rows} == {"SENT", "RETRY"} and {row[2] for row in outbox_rows} == {1}


def test_failed_requests_are_sent_again_when_the_clock_reaches_them(spark, tmp_path):
    store, broker = str(tmp_path), Broker()
    replace_table(analyses(spark, range(6)), f"{store}/{ANALYSES}")
    readings = iter([NOW + timedelta(hours=h) for h in (1, 2, 3, 4)])
    drained = run_stored_dispatch(cases(spark, range(9)), store, broker, version=1, job=8, now=NOW, chunk=4, clock=lambda: next(readings))
    assert [len(wave) for wave in broker.sent if wave] == [9, 3, 3]
    assert (drained.published, drained.retried) == (6, 9)
    rows = {r.request_id: r for r in drained.outbox.collect()}
    assert {rows[key(c)].dispatch_status for c in range(9) if c % 3} == {"SENT"}
    assert {(rows[key(c)].dispatch_status, rows[key(c)].attempt_count) for c in range(0, 9, 3)} == {("DEAD", 3)}
    # A clock that stands still changes nothing: what has failed is not due yet.
    again = Broker()
    still = str(tmp_path / "still")
    replace_table(analyses(spark, range(6)), f"{still}/{ANALYSES}")
    run_stored_dispatch(cases(spark, range(9)), still, again, version=1, job=8, now=NOW, chunk=4, clock=lambda: NOW)
    assert [len(wave) for wave in again.sent if wave] == [9]
