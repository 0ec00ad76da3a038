"""Event features on hand-made logs."""

import json
import os
import random
from datetime import date, timedelta

import pytest

from memberlytics.operators import events
from memberlytics.params import RunParams
from memberlytics.plans import event_features
from memberlytics.schemas import CLICK_COLUMNS, SCHEMAS
from memberlytics.sources.event_logs import day_signs, in_scan_window, scan_event_logs

AS_OF = date(2024, 1, 30)


def log(spark, *rows):
    """(member, event, event day, product type, tags[, arrival day])"""
    full = [(m, e, f"{day}T10:00:00.000Z", (kind, tags), arrived[0] if arrived else day) for m, e, day, kind, tags, *arrived in rows]
    return spark.createDataFrame(full, SCHEMAS["customer_event_logs_raw"])


def counts(row):
    return {c: row[c] for c in CLICK_COLUMNS if row[c]}


def test_windows_and_zero_rows(spark):
    events_ = log(
        spark,
        (1, "click_compare", "2024-01-24", None, None),
        (1, "click_compare", "2024-01-23", None, None),
        (1, "click_compare", "2024-01-30", None, None),
        (1, "click_change_success", "2023-11-02", None, None),
        (1, "click_change_success", "2023-11-01", None, None, "2023-11-02"),
        (2, "something_else", "2024-01-30", None, None),
        (3, "click_compare", "2024-01-30", None, None, "2024-01-31"),
    )
    found = {r.member_id: r for r in events.event_counts(in_scan_window(events_, AS_OF), AS_OF).collect()}
    assert counts(found[1]) == {"click_compare_cnt": 2, "click_change_success_cnt": 1}
    assert counts(found[2]) == {} and 3 not in found


def test_product_types_are_folded_by_upper_case(spark):
    events_ = log(
        spark,
        (1, "x", "2024-01-30", "iptv", None),
        (1, "y", "2024-01-29", "IPTV", None),
        (1, "y", "2024-01-29", "addon", None),
        (1, "z", "2024-01-29", None, None),
        (2, "z", "2024-01-02", "iptv", None),
    )
    found = {r.member_id: r.product_type_clicks for r in events.product_type_clicks(events_, AS_OF).collect()}
    assert {k: json.loads(v) for k, v in found.items()} == {1: {"IPTV": 2, "ADDON": 1}}


def test_tags_repeat_and_nulls_vanish(spark):
    detail = "click_product_detail"
    events_ = log(
        spark,
        (1, detail, "2024-01-30", None, ["a", "a", "b"]),
        (2, detail, "2024-01-30", None, None),
        (3, detail, "2024-01-30", None, []),
        (4, "click_compare", "2024-01-30", None, ["a"]),
        (5, detail, "2024-01-20", None, ["a"]),
    )
    found = {(r.member_id, r.tag): r.tag_cnt for r in events.tag_counts(events_, AS_OF).collect()}
    assert found == {(1, "a"): 2, (1, "b"): 1}


def test_top_tags_by_count_then_name(spark):
    tags = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 2), (1, "d", 1), (2, "z", 9)], "member_id bigint, tag string, tag_cnt bigint")
    found = {r.member_id: json.loads(r.product_type_top_tags) for r in events.top_tags(tags).collect()}
    assert found == {1: ["b", "c", "a"], 2: ["z"]}


def test_features_have_defaults_and_order(spark):
    events_ = log(
        spark,
        (9, "click_penalty", "2023-12-01", "iptv", ["a"]),
        (2, "click_product_detail", "2024-01-28", "Iptv", ["b", "a"]),
    )
    rows = events.build_event_features(events_, AS_OF).collect()
    assert [r.member_id for r in rows] == [2, 9]
    assert (rows[0].product_type_clicks, rows[0].product_type_top_tags) == ('{"IPTV":1}', '["a","b"]')
    assert (rows[1].product_type_clicks, rows[1].product_type_top_tags) == ("{}", "[]")
    assert counts(rows[1]) == {} and rows[0].snapshot_date == AS_OF


@pytest.mark.parametrize("seed", [1, 2])
def test_one_scan_equals_separate_operators(spark, seed):
    rng = random.Random(seed)
    names = [*events.EVENT_BY_COLUMN.values(), "other"]
    rows = []
    for _ in range(600):
        # One member holds a third of all events.
        member = 0 if rng.random() < 1 / 3 else rng.randrange(1, 20)
        day = date.fromordinal(AS_OF.toordinal() - rng.choice([0, 1, 5, 6, 7, 30, 88, 89, 90]))
        rows.append((member, rng.choice(names), str(day), rng.choice([None, "a", "A", "b"]), rng.choice([None, [], ["x"], ["x", "y", "z"]])))
    events_ = log(spark, *rows)
    merged = {r.member_id: r for r in events.counts_and_clicks(events_, AS_OF).collect()}
    for row in events.event_counts(events_, AS_OF).collect():
        assert counts(merged[row.member_id]) == counts(row)
    clicks = {r.member_id: r.product_type_clicks for r in events.product_type_clicks(events_, AS_OF).collect()}
    assert {m: r.product_type_clicks for m, r in merged.items()} == {m: clicks.get(m, "{}") for m in merged}


def some_events(rng, n, days):
    """Events of members of whom one holds a third, some late, some without a type or member."""
    names = [*events.EVENT_BY_COLUMN.values(), "other", "click_product_detail"]
    out = []
    for _ in range(n):
        member = 0 if rng.random() < 1 / 3 else rng.choice([None, *range(1, 12)])
        arrived = AS_OF - timedelta(days=rng.choice(days))
        happened = arrived - timedelta(days=rng.choice([0, 0, 0, 1, 3, 6, 30, -1]))
        tags = rng.choice([None, [], ["x"], ["x", "y", "z"], ["y", "y", None], ["w", "x"]])
        out.append((member, rng.choice(names), str(happened), rng.choice([None, "a", "A", "b"]), tags, str(arrived)))
    return out


def separately(events_, as_of):
    """The feature table put together from the separate operators."""
    counted = {r.member_id: r for r in events.event_counts(events_, as_of).collect()}
    clicks = {r.member_id: r.product_type_clicks for r in events.product_type_clicks(events_, as_of).collect()}
    tags = {r.member_id: r.product_type_top_tags for r in events.top_tags(events.tag_counts(events_, as_of)).collect()}
    known = {m: (clicks.get(m, "{}"), tags.get(m, "[]")) if m is not None else ("{}", "[]") for m in counted}
    return {m: (as_of, m, *[row[c] for c in CLICK_COLUMNS], *known[m]) for m, row in counted.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_features_equal_separate_operators(spark, seed):
    rng = random.Random(seed)
    events_ = log(spark, *some_events(rng, 900, [0, 1, 2, 5, 6, 7, 30, 88, 89]))
    assert {r.member_id: tuple(r) for r in events.build_event_features(events_, AS_OF).collect()} == separately(events_, AS_OF)
    sums = events.daily_partials(events_)
    assert sums.schema.names == SCHEMAS["event_daily_partials"].names
    assert {r.member_id: tuple(r) for r in events.features_of_facts(sums, AS_OF).collect()} == separately(events_, AS_OF)
    assert events.build_event_features(events_.limit(0), AS_OF).count() == 0


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_daily_partials_read_each_day_once(spark, tmp_path):
    """Three days in a row, with late arrivals: as the whole log gives, from one new day each."""
    rng, path, store = random.Random(8), str(tmp_path / "log"), str(tmp_path / "store")
    whole = log(spark, *some_events(rng, 1500, [0, 1, 2, 3, 8, 40, 90, 91]))
    days = [AS_OF - timedelta(days=back) for back in (2, 1, 0)]
    whole.where(f"dt < '{days[0]}'").write.partitionBy("dt").parquet(path)
    for n, day in enumerate(days):
        whole.where(f"dt = '{day}'").write.mode("append").partitionBy("dt").parquet(path)
        params = RunParams(day, "202312")
        if n:
            # Whatever was read before is no longer needed: only its listing counts.
            for file in tmp_path.glob("log/dt=*/*.parquet"):
                if str(day) not in str(file.parent) and not file.name.startswith("."):
                    stat, size = file.stat(), file.stat().st_size
                    file.write_bytes(b"x" * size)
                    os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
        got = event_features.run_event_features(spark, path, store, params, incremental=True)
        direct = events.build_event_features(in_scan_window(whole, day), day)
        assert rows_of(got) == rows_of(direct)
        assert event_features.refresh_partials(spark, path, store, day) == []


def test_changed_days_are_read_again(spark, tmp_path):
    rng, path, store = random.Random(9), str(tmp_path / "log"), str(tmp_path / "store")
    params = RunParams(AS_OF, "202312")
    first, late = some_events(rng, 300, [0, 1, 9]), some_events(rng, 50, [9])
    log(spark, *first).write.partitionBy("dt").parquet(path)
    event_features.run_event_features(spark, path, store, params, incremental=True)
    log(spark, *late).write.mode("append").partitionBy("dt").parquet(path)
    nine = AS_OF - timedelta(days=9)
    assert event_features.refresh_partials(spark, path, store, AS_OF) == [nine]
    again = event_features.run_event_features(spark, path, store, params, incremental=True)
    assert rows_of(again) == rows_of(events.build_event_features(log(spark, *first, *late), AS_OF))
    # A day that has lost its files counts no more.
    other = str(tmp_path / "other")
    scan_event_logs(spark, path, AS_OF).where(f"dt <> '{nine}'").write.partitionBy("dt").parquet(other)
    assert nine not in day_signs(spark, other, AS_OF)
    moved = event_features.run_event_features(spark, other, store, params, incremental=True)
    assert rows_of(moved) == rows_of(events.build_event_features(scan_event_logs(spark, other, AS_OF), AS_OF))
