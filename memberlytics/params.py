"""Run parameters: the snapshot date and the month key every job is driven by."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business time zone and the accepted date format.
BUSINESS_ZONE = "Asia/Seoul"
DATE_FORMAT = r"\d{4}-\d{2}-\d{2}"


@dataclass(frozen=True)
class RunParams:
    """`as_of` is the snapshot date, `yyyymm` the month the monthly inputs are read for."""

    as_of: date
    yyyymm: str

    @property
    def snapshot_date(self) -> Column:
        return F.lit(self.as_of)


def previous_month(day: date) -> str:
    return (day.replace(day=1) - timedelta(days=1)).strftime("%Y%m")


def resolve_params(snapshot_date: str | None = None, today: date | None = None) -> RunParams:
    """Parse a strict yyyy-MM-dd date; a missing or blank one means today in the business zone.

    Monthly inputs (usage, billing, satisfaction) are final only after month end, so the month
    key is the one before the snapshot's.
    """
    if snapshot_date is None or not snapshot_date.strip():
        as_of = today or datetime.now(ZoneInfo(BUSINESS_ZONE)).date()
    elif not re.fullmatch(DATE_FORMAT, snapshot_date):
        raise ValueError(f"snapshot date {snapshot_date!r} is not in the form yyyy-MM-dd")
    else:
        as_of = date.fromisoformat(snapshot_date)
    return RunParams(as_of, previous_month(as_of))
