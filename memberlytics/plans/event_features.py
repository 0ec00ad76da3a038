"""Event feature job: scan the log, aggregate, replace the snapshot, check it.

The job keeps the sums of every arrival day beside its result. A run then opens only the days of the
log whose files have changed since their sums were stored, as a rule the newest one, and adds up the
stored sums of the window: the log is read once in all, not once for each of the dates a day counts for.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from memberlytics.operators.events import build_event_features, daily_partials, features_of_facts
from memberlytics.operators.quality import require_not_empty, row_counts
from memberlytics.params import RunParams
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.event_logs import SCAN_DAYS, day_signs, scan_event_days, scan_event_logs
from memberlytics.sources.versions import read_snapshots, replace_snapshot_counted, replace_snapshots, snapshot_notes

TABLE = "user_event_features_7d"
PARTIALS = "event_daily_partials"


def run_event_features(spark: SparkSession, log_path: str, store: str, params: RunParams, incremental: bool = False) -> DataFrame:
    if not incremental:
        return store_event_features(scan_event_logs(spark, log_path, params.as_of), store, params)
    refresh_partials(spark, log_path, store, params.as_of)
    return _stored(features_of_facts(read_partials(spark, store, params.as_of), params.as_of, ordered=False), store, params)


def store_event_features(events: DataFrame, store: str, params: RunParams) -> DataFrame:
    """Build from events already limited to the scan window; returns the stored snapshot."""
    return _stored(build_event_features(events, params.as_of, ordered=False), store, params)


def _stored(built: DataFrame, store: str, params: RunParams) -> DataFrame:
    stored, counts = replace_snapshot_counted(built, f"{store}/{TABLE}", params.as_of, row_counts())
    require_not_empty(counts, "event feature")
    return stored


def refresh_partials(spark: SparkSession, log_path: str, store: str, as_of: date) -> list[date]:
    """Sum up again the days of the window whose files are not those of the stored sums; returns these days.

    All of them change in one commit. A day that has lost its files becomes empty.
    """
    there, read = day_signs(spark, log_path, as_of), snapshot_notes(spark, f"{store}/{PARTIALS}")
    window = [as_of - timedelta(days=back) for back in range(SCAN_DAYS)]
    changed = [day for day in window if there.get(day, "") != read.get(day, "")]
    if changed:
        sums = daily_partials(scan_event_days(spark, log_path, changed))
        replace_snapshots(sums, f"{store}/{PARTIALS}", {day: there.get(day, "") for day in changed})
    return changed


def read_partials(spark: SparkSession, store: str, as_of: date) -> DataFrame:
    """Stored sums of the arrival days of the scan window."""
    first = as_of - timedelta(days=SCAN_DAYS - 1)
    return read_snapshots(spark, f"{store}/{PARTIALS}", SCHEMAS[PARTIALS], as_of, first)
