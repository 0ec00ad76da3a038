"""Raw scores, T-scores and personas on hand-made rows."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from memberlytics.functions.scores import INDEX_CODES
from memberlytics.operators import activity, index
from memberlytics.operators.members import base_members, family_counts, with_family_size
from memberlytics.schemas import SCHEMAS

AS_OF = date(2024, 1, 30)


def scored(spark, rows, suffix="tscore", partitions=3):
    return spark.createDataFrame([(AS_OF, *r) for r in rows], SCHEMAS[f"index_{suffix}_snapshot"]).repartition(partitions)


def test_constant_index_scores_exactly_50(spark):
    raw = scored(spark, [(m, 0.1 + 0.2, float(m), 0.7, 1 / 3, 0.0, 2.0) for m in range(50)], "raw")
    found = index.build_tscore_snapshot(raw, AS_OF)
    stats = found.agg(
        *[F.min(f"{c}_tscore").alias(f"{c}_lo") for c in INDEX_CODES],
        *[F.max(f"{c}_tscore").alias(f"{c}_hi") for c in INDEX_CODES],
        F.avg("benefit_trend_tscore").alias("mean"),
        F.stddev_pop("benefit_trend_tscore").alias("deviation"),
    ).first()
    for code in INDEX_CODES:
        if code != "benefit_trend":
            assert stats[f"{code}_lo"] == stats[f"{code}_hi"] == 50.0
    assert stats.mean == pytest.approx(50) and stats.deviation == pytest.approx(10)


def test_empty_snapshot_has_no_scores(spark):
    assert index.build_tscore_snapshot(scored(spark, [], "raw"), AS_OF).count() == 0


def test_only_the_given_snapshot_is_scored(spark):
    other = spark.createDataFrame([(date(2024, 1, 23), 1, *[9.0] * 6)], SCHEMAS["index_raw_snapshot"])
    raw = scored(spark, [(m, *[float(m)] * 6) for m in range(4)], "raw").unionByName(other)
    found = index.build_tscore_snapshot(raw, AS_OF)
    assert found.count() == 4 and found.agg(F.avg("explore_tscore")).first()[0] == pytest.approx(50)


def test_winner_ties_and_nulls(spark):
    rows = [
        (1, 60.0, 60.0, 50.0, 50.0, 50.0, 50.0),
        (2, 40.0, 41.0, 42.0, 43.0, 44.0, 45.0),
        (3, 99.0, 50.0, 50.0, 50.0, None, 50.0),
        (4, 50.0, 50.0, 50.0, 50.0, 50.0, 50.0),
        (5, None, None, 1.0, 1.0, 1.0, 1.0),
    ]
    found = {r.member_id: (r.source_index_code, r.source_tscore) for r in index.winning_index(scored(spark, rows)).collect()}
    assert found == {
        1: ("benefit_trend", 60.0), 2: ("stability", 45.0), 3: ("internet_security", None), 4: ("benefit_trend", 50.0), 5: ("benefit_trend", None),
    }


def test_winner_equals_unpivoted_ranking(spark):
    rng = random.Random(3)
    rows = [(m, *[rng.choice([None, 40.0, 50.0, 60.0]) for _ in INDEX_CODES]) for m in range(300)]
    tscores = scored(spark, rows)
    best = {}
    for r in index.unpivot_scores(tscores).collect():
        rank = (r.tscore is not None, -(r.tscore or 0), r.index_code)
        best[r.member_id] = min(best.get(r.member_id, rank), rank)
    found = {r.member_id: r.source_index_code for r in index.winning_index(tscores).collect()}
    assert found == {m: rank[2] for m, rank in best.items()}


PERSONAS = [
    (1, "SPACE_SHERLOCK", 1, True), (2, "SPACE_SHERLOCK", 2, True), (3, "SPACE_SHERLOCK", 3, False), (4, "SPACE_SURFER", 1, True),
    (5, "SPACE_SURFER", 1, True), (6, "SPACE_OCTOPUS", 1, True), (7, "SPACE_GRAVITY", 1, True), (8, "SPACE_GUARDIAN", 1, True),
    (9, "SPACE_EXPLORER", 1, False), (10, "OUT_OF_USE", 9, True),
]


def test_newest_active_persona_type(spark):
    types = spark.createDataFrame(PERSONAS, SCHEMAS["persona_type"])
    found = {r.character_name: r.persona_type_id for r in index.latest_persona_type(types).collect()}
    assert found["SPACE_SHERLOCK"] == 2 and found["SPACE_SURFER"] == 5 and "SPACE_EXPLORER" not in found


def test_members_without_active_persona_are_left_out(spark):
    types = spark.createDataFrame(PERSONAS, SCHEMAS["persona_type"])
    tscores = scored(spark, [(1, 60.0, *[50.0] * 5), (2, *[50.0] * 5, 70.0)])
    rows = index.build_persona_snapshot(tscores, types, AS_OF).collect()
    assert [tuple(r) for r in rows] == [(AS_OF, 1, 2, "SPACE_SHERLOCK", "explore", 60.0)]


def test_family_size_with_hot_and_missing_groups(spark):
    # A third of the members in one group, a third in none, the rest in small groups.
    rows = [(m, None, None, None, -5 if m % 3 == 0 else None if m % 3 == 1 else m // 6, None) for m in range(3000)]
    member = spark.createDataFrame(rows, SCHEMAS["member"])
    sizes = {}
    for row in rows:
        sizes[row[4]] = sizes.get(row[4], 0) + 1
    found = with_family_size(base_members(member), family_counts(member)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.family_member_cnt == (None if row.family_group_id is None else sizes[row.family_group_id])


def test_activity_windows(spark):
    coupons = [
        (1, 1, True, datetime(2024, 1, 24)), (2, 1, True, datetime(2024, 1, 23, 23, 59)), (3, 1, True, datetime(2024, 1, 30, 23, 59)),
        (4, 1, False, datetime(2024, 1, 30)), (5, 1, True, None), (6, 2, True, datetime(2024, 1, 31)),
    ]
    used = activity.coupon_7d(spark.createDataFrame(coupons, SCHEMAS["member_coupon"]), AS_OF)
    assert [tuple(r) for r in used.collect()] == [(1, 2)]

    december, january = datetime(2023, 12, 31, 23), datetime(2024, 1, 1)
    cases = [
        (1, 1, "t", 4, january, december, january), (2, 1, "t", 1, january, None, december), (3, 1, "t", 5, january, january, december),
        (4, 1, "t", None, january, december, december), (5, 2, "t", 5, december, None, january),
    ]
    mean = activity.support_monthly(spark.createDataFrame(cases, SCHEMAS["support_case"]), "202312")
    assert [tuple(r) for r in mean.collect()] == [(1, 2.5)]
